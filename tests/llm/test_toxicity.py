import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import toxicity
from lakeloom.llm.common import crc_fold
from lakeloom.llm.textkit import word_spans

from .conftest import passage


def auc(score, label):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    n = label.sum()
    return (rank[label == 1].sum() - n * (n - 1) / 2) / n / (len(label) - n)


@pytest.fixture(scope="module")
def labelled(spark, documents):
    """Texts of which every fourth holds an insult."""
    rows = [(i, passage(i, 80) + (" you rotten scoundrel " if i % 4 == 0 else " you gentle neighbour ") + passage(i + 1000, 40)) for i in range(400)]
    return documents(rows), spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")


def test_held_out_accuracy(labelled):
    docs, labels = labelled
    model = toxicity.train(docs, labels)
    scored = toxicity.score_texts(docs.filter(crc_fold("doc_id", 4) == 2), model).select("doc_id", "score").toPandas()
    assert scored["score"].between(0, 1).all()
    assert auc(scored["score"].to_numpy(), (scored["doc_id"].to_numpy() % 4 == 0).astype(int)) > 0.95


def test_held_out_labels_are_not_read(labelled, spark):
    docs, labels = labelled
    other = labels.withColumn("toxic", F.when(crc_fold("doc_id", 4) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train(docs, labels), toxicity.train(docs, other)
    assert (a.curve, a.prior) == (b.curve, b.prior)


def test_odd_rows(labelled, documents, odd_rows):
    docs, labels = labelled
    model = toxicity.train(docs, labels)
    frame = documents(odd_rows).withColumn("k", F.lit(1)).withColumn("gram", F.lit("x"))
    got = toxicity.score_texts(frame, model).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in got if not (r["text"] or "").strip(" \t\n\x0b")} == {model.prior}
    assert len({r["score"] for r in got if r["doc_id"] == 5}) == 1
    assert toxicity.score_texts(documents([]), model).count() == 0


def test_no_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(documents([(1, "a b c")]), none)
    assert [r["score"] for r in toxicity.score_texts(documents([(1, "a b c"), (2, None)]), model).collect()] == [0.0, 0.0]
    one = spark.createDataFrame([(1, 1), (1, None), (None, 1)], "doc_id long, toxic int")
    assert 0 <= toxicity.score_texts(documents([(1, "a")]), toxicity.train(documents([(1, "a")]), one)).first()["score"] <= 1


def words_of(text):
    return re.findall("[a-zà-ÿ0-9]+", text.lower())


def brute_evidence(texts, word):
    """log P(word | toxic) - log P(word | ordinary) by interpolated Kneser-Ney models from dictionaries."""
    n, order = Counter(), toxicity.ORDERS
    for text, toxic in texts:
        for w in set(words_of(text)):
            letters = "^" * (order - 1) + w + "^"
            for i in range(order - 1, len(letters)):
                for k in range(order):
                    n[toxic, k, letters[i - k : i + 1], i - k < order - 1] += 1
    pool, counts = Counter(), Counter()
    for (c, k, g, start), x in n.items():
        pool[g] += x
        if k == order - 1 or start:
            counts[c, g] += x
        if k and (not start or k == 1):
            counts[c, g[1:]] += 1
    share = lambda c, g: sum(counts[x, g] for x in (0, 1)) if len(g) <= toxicity.SHARED else counts[c, g]
    follow = {}
    for c, g in counts:
        follow.setdefault(g[:-1], set()).add(g)

    def p(c, g):
        if not g:
            return 1 / toxicity.LETTERS
        total = sum(share(c, x) for x in follow.get(g[:-1], ()))
        kept = {x: max(share(c, x) - toxicity.DISCOUNT, 0) / total for x in follow.get(g[:-1], ()) if total and pool[x] >= toxicity.RARE}
        return kept.get(g, 0) + (1 - sum(kept.values())) * p(c, g[1:])

    letters = "^" * (order - 1) + word + "^"
    return sum(math.log(p(1, letters[i - order + 1 : i + 1]) / p(0, letters[i - order + 1 : i + 1])) for i in range(order - 1, len(letters)))


def test_against_brute_force(labelled):
    """Words' evidence equals that of Kneser-Ney models from dictionaries."""
    docs, labels = labelled
    model = toxicity.train(docs, labels)
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    texts = [(r["text"], toxic[r["doc_id"]]) for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    words = ["rotten", "scoundrel", "gentle", "neighbour", "you", "alpha", "unheard", "rottener", "x", "é"]
    data, offsets = toxicity.prepared(pa.array([" ".join(words)]))
    starts, ends = word_spans(data, offsets)
    got = toxicity.word_evidence(model, data, starts, ends)
    assert got == pytest.approx([brute_evidence(texts, w) for w in words], abs=1e-4)
    assert got[0] > 3 and got[2] < -3 and abs(got[6]) < got[0] / 5


def test_probabilities_sum_to_one(labelled):
    """After any letters, the shares of all letters are a distribution in both classes."""
    docs, labels = labelled
    model = toxicity.train(docs, labels)
    own, taken = model.lookups()
    for context in ("", "r", "rot", "otte", "zzzz"):
        p = np.full((toxicity.LETTERS, 2), 1 / toxicity.LETTERS)
        for k in range(min(len(context) + 1, toxicity.ORDERS)):
            ctx = 0
            for x in context[len(context) - k :].encode():
                ctx = ctx * toxicity.LETTERS + x + 1
            p = own[k].of(ctx * toxicity.LETTERS + np.arange(toxicity.LETTERS)) + (1 - taken[k].of(np.full(toxicity.LETTERS, ctx))) * p
        assert p.sum(0) == pytest.approx([1, 1], abs=1e-4)


def test_lookup():
    r = np.random.default_rng(1)
    keys = np.unique(r.integers(0, 1 << 40, 5000))
    values = r.random((len(keys), 2)).astype(np.float32)
    made = toxicity.Lookup(keys, values)
    assert len(made.late_keys) and (made.of(keys) == values).all() and (made.of(keys + 1)[~np.isin(keys + 1, keys)] == 0).all()
    assert (toxicity.Lookup(keys[:0], values[:0]).of(keys) == 0).all()


def test_clean_scores_do_not_grow_with_length(spark, documents):
    """Ordinary texts of ten times the length score no higher."""
    rows = [(i, passage(i, 30 if i % 2 else 300) + (" you rotten scoundrel" if i % 5 == 0 else " you gentle neighbour")) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(600)], "doc_id long, toxic int")
    docs = documents(rows)
    got = toxicity.score_texts(docs, toxicity.train(docs, labels)).filter("doc_id % 5 <> 0").select("doc_id", "score").toPandas()
    short, long = (got[got["doc_id"] % 2 == x]["score"].mean() for x in (1, 0))
    assert long < short + 0.02 and max(long, short) < 0.1


def test_a_column_named_score_is_replaced(labelled):
    docs, labels = labelled
    model = toxicity.train(docs, labels)
    got = toxicity.score_texts(docs.withColumn("score", F.lit("old")).withColumn("x0", F.lit(1)), model)
    assert got.columns == [*docs.columns, "x0", "score"] and got.agg(F.max("score")).first()[0] <= 1


def test_query(spark, sf):
    got = toxicity.op2_toxicity(spark, sf)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert got.filter((F.col("predicted") == 1) != (F.col("score") >= 0.3)).count() == 0
