import random

from pyspark.sql import functions as F

from lakeloom.llm import decontam

from .conftest import passage


def distances(item, text):
    """Least distance of item to a part of text, by the plain recurrence."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i in range(1, len(item) + 1):
            new.append(min(row[i] + 1, new[i - 1] + 1, row[i - 1] + (item[i - 1] != c)))
        row = new
        best = min(best, row[-1])
    return best


def edited(r, text, n):
    x = list(text)
    for _ in range(n):
        i = r.randrange(len(x))
        x[i : i + 1] = r.choice([[], ["q"], [x[i], "z"]])
    return "".join(x)


def test_myers():
    r = random.Random(1)
    for _ in range(200):
        item, text = ("".join(r.choice("abc") for _ in range(n)) for n in (r.randint(1, 80), r.randint(0, 100)))
        assert decontam.search(decontam.masks(item), len(item), text)[0] == distances(item, text)


def test_pieces_cover():
    for m in range(1, 60):
        for k in range(1, min(m, 6)):
            got = decontam.pieces("x" * m, k)
            assert len(got) == k + 1 and "".join(p for _, p in got) == "x" * m


def test_against_brute_force(spark, documents, odd_rows):
    r = random.Random(2)
    items = [(i, passage(100 + i, 12).upper() if i % 2 else passage(100 + i, 12)) for i in range(8)] + [(8, None), (9, ""), (None, passage(1, 20)), (10, passage(100, 12))]
    rows = [(i, passage(i, 15) + "  \n" + edited(r, items[i % 8][1], i % 12) + "\t" + passage(i + 50, 15)) for i in range(48)] + [(100 + i, passage(i + 900, 60)) for i in range(10)] + [(i and i + 500, t) for i, t in odd_rows]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for doc, text in rows:
        for item, t in items:
            a = decontam.normalised(t)
            if item is not None and a:
                d = distances(a, decontam.normalised(text)[:2000])
                if d <= decontam.budget(len(a)):
                    want.add((doc, item, d))
    docs = documents(rows)
    got = {(x["doc_id"], x["item_id"], x["distance"]) for x in decontam.matches(docs, benchmark).collect()}
    assert got == want and len(want) > 20
    kept = decontam.clean(docs.withColumn("item_id", F.lit(1)), benchmark)
    assert kept.columns == [*docs.columns, "item_id"]
    assert sorted(str(x["doc_id"]) for x in kept.collect()) == sorted(str(d) for d, _ in rows if d not in {w[0] for w in want})


def test_short_items(spark, documents):
    """Items too short for edits are found where they stand alone, unchanged."""
    benchmark = spark.createDataFrame([(1, "The  Capital of\nPeru"), (2, "x"), (3, " \t")], "item_id long, text string")
    rows = [(1, "ask: the capital of peru"), (2, "the capital of peruvians, the capital of peru!"), (3, "THE CAPITAL\tOF PERU is"), (4, "the capitol of peru"), (5, "an x"), (6, "axe xx"), (7, None), (8, ""), (9, "athe capital of peru the capital of peru")]
    got = {(r["doc_id"], r["item_id"], r["distance"], r["start"], r["end"]) for r in decontam.matches(documents(rows), benchmark).collect()}
    assert got == {(1, 1, 0, 5, 24), (3, 1, 0, 0, 19), (5, 2, 0, 3, 4), (9, 1, 0, 21, 40)}
    assert sorted(r["doc_id"] for r in decontam.clean(documents(rows), benchmark).collect()) == [2, 4, 6, 7, 8]


def test_blocks_agree(spark, documents, monkeypatch):
    items = [(i, passage(100 + i, 12)) for i in range(30)] + [(40, "short item")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = documents([(i, passage(i, 20) + " " + items[i][1]) for i in range(30)])
    one = {(r["doc_id"], r["item_id"]) for r in decontam.matches(docs, benchmark).collect()}
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 500)
    assert {(r["doc_id"], r["item_id"]) for r in decontam.matches(docs, benchmark).collect()} == one == {(i, i) for i in range(30)}
    assert decontam.blocks(benchmark)[1] > 3
    assert decontam.clean(docs.unionAll(documents([(99, "none of them")])), benchmark).select("doc_id").collect() == [(99,)]


def test_empty(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.matches(documents([(1, "x")]), none).count() == 0 and decontam.clean(documents([(1, "x")]), none).count() == 1
    some = spark.createDataFrame([(1, passage(1, 20))], "item_id long, text string")
    assert decontam.matches(documents([]), some).count() == 0


def test_query(spark, sf):
    got = decontam.op5_decontam(spark, sf).collect()
    items = {r["item_id"]: decontam.normalised(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    docs = {r["doc_id"]: decontam.normalised(r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    exact = {(d, i) for d, t in docs.items() for i, x in items.items() if x and (x in t if len(x) >= decontam.SHORT else f" {x} " in f" {t} ")}
    assert exact == {(r["doc_id"], r["item_id"]) for r in got if r["distance"] == 0}
