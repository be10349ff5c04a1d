import hashlib

import pytest
from pyspark.sql import functions as F

from lakeloom.llm import line_dedup
from lakeloom.llm.queries import SQL
from tests.oracle import same

LONG = "this line is long enough to count"


def brute(rows, least=20, docs=3):
    low = str.maketrans(line_dedup.UPPER, line_dedup.LOWER)
    key = lambda s: s.strip(" \t\n\x0b\x0c\r").translate(low)
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= least:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (i is not None and len(holders.get(key(x), ())) >= docs and max(holders[key(x)]) != i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r["doc_id"], r["_ld_lines"], r["_ld_dropped"], r["text"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("batches, fanout", [(1, 2), (3, 2), (5, 3)])
def test_against_brute_force(documents, odd_rows, batches, fanout):
    rows = [(i, "\n".join([f"{LONG} {j % 4}" if (i + j) % 3 else f"  {LONG.upper()} {j % 4}\t" for j in range(i % 5)] + ["short", "", f"only here {i} {i} {i}"])) for i in range(10, 40)] + odd_rows
    assert found(line_dedup.dedup_lines(documents(rows), batches=batches, fanout=fanout)) == brute(rows)


def test_lines_repeat_in_the_keeper(documents):
    rows = [(1, LONG), (2, f"{LONG}\nx\n{LONG}"), (3, f"{LONG}\n{LONG}")]
    assert found(line_dedup.dedup_lines(documents(rows))) == [(1, 1, 1, ""), (2, 3, 2, "x"), (3, 2, 0, f"{LONG}\n{LONG}")]


def test_two_documents_keep_their_lines(documents):
    rows = [(1, LONG), (2, LONG), (2, LONG)]
    assert found(line_dedup.dedup_lines(documents(rows))) == brute(rows)


def test_empty_and_extra_columns(documents):
    assert line_dedup.dedup_lines(documents([])).count() == 0
    df = documents([(i, LONG) for i in range(4)]).withColumn("h1", F.lit(7)).withColumn("keeper", F.lit("mine"))
    out = line_dedup.dedup_lines(df)
    assert out.columns[: len(df.columns)] == df.columns and {r["keeper"] for r in out.collect()} == {"mine"}


def test_runs_are_not_shuffled(spark, documents):
    """Neither a batch's anti-join nor a compaction exchanges what lies in runs."""
    docs = documents([(i, "\n".join(f"{LONG} {j}" for j in range(i % 7))) for i in range(60)])
    runs = line_dedup.build_runs(docs, batches=5, fanout=2)
    assert len(runs.open) > 1 and any(runs.done)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        held = [r for level in (*runs.open, *runs.done) for r in level]
        for plan in (line_dedup.LineRuns.joined(held[0], held[-1]), held[0].join(held[-1].select("h1", "h2"), ["h1", "h2"], "left_anti")):
            assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    runs.forget()
    assert not spark.catalog.listTables() or not any(t.name.startswith("lakeloom_") for t in spark.catalog.listTables())


def test_batches_follow_the_size(documents, monkeypatch):
    docs = documents([(i, "x" * 1000) for i in range(30)])
    assert line_dedup.batches_of(docs) == line_dedup.LEAST_BATCHES
    monkeypatch.setattr(line_dedup, "BATCH", 5000)
    assert line_dedup.batches_of(docs) == 6 and line_dedup.batches_of(documents([])) == line_dedup.LEAST_BATCHES


def test_query(spark, sf):
    same(line_dedup.op1_line_dedup(spark, sf), SQL["op1_line_dedup"], sf)
    row = line_dedup.op1_line_dedup(spark, sf).filter("n_dropped = 0").first()
    text = spark.read.parquet(f"{sf}/documents.parquet").filter(F.col("doc_id") == row["doc_id"]).first()["text"]
    assert hashlib.sha256(text.encode()).hexdigest() == row["kept_sha256"]
