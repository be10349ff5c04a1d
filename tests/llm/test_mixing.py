import re

import pytest
from pyspark.sql import functions as F

from lakeloom.llm import mixing
from lakeloom.llm.queries import SQL
from tests.oracle import same

from .conftest import passage


def filled(sizes):
    """Targets by resharing the excess until none is above its cap."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight, total = {s: 1 + i % 3 for i, s in enumerate(order)}, sum(sizes.values())
    done = {}
    while True:
        rest, open_ = total - sum(done.values()), [s for s in order if s not in done]
        level = rest / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if level * weight[s] > 3 * sizes[s]]
        if not over:
            return done | {s: level * weight[s] for s in open_}
        done |= {s: 3.0 * sizes[s] for s in over}


def test_targets_and_copies(documents):
    rows = [(i, passage(i, 20 + i % 7), s) for i, s in enumerate(["b"] * 120 + ["a"] * 10 + ["é"] * 5 + [None] * 3 + ["z"] * 60)]
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want, docs = filled(sizes), documents(rows)
    source = {i: s for i, _, s in rows}
    got = mixing.plan_copies(docs).collect()
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s]) and 0 <= r["copies"] <= 3
        assert r["copies"] in (int(want[s] / sizes[s]), int(want[s] / sizes[s]) + 1)
    copies = {r["doc_id"]: r["copies"] for r in got}
    mixed = {r["doc_id"]: r["n"] for r in mixing.mix(docs).groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert mixed == {k: v for k, v in copies.items() if v}


def test_taken_comes_near(documents):
    rows = [(i, passage(i, 10), f"s{i % 4}") for i in range(4000)]
    got = mixing.plan_copies(documents(rows)).groupBy(F.col("doc_id") % 4, "target").agg(F.sum(F.col("size") * F.col("copies")).alias("taken")).collect()
    assert all(abs(r["taken"] - r["target"]) < 0.1 * r["target"] for r in got)


def test_odd_rows(documents, odd_rows):
    docs = documents([(*r, None if i % 3 else "x") for i, r in enumerate(odd_rows)]).withColumn("copies", F.lit("c")).withColumn("size", F.lit(-1))
    got = mixing.plan_copies(docs).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted(r["size"] for r in got) == sorted(size(t) for _, t in odd_rows)
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.plan_copies(documents([])).count() == 0 and mixing.mix(documents([])).count() == 0
    assert {r["copies"] for r in mixing.plan_copies(documents([(1, None), (2, "")])).collect()} == {0}


def test_no_python_in_the_plan(spark, sf):
    text = mixing.op4_mixing(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


def test_query(spark, sf):
    same(mixing.op4_mixing(spark, sf), SQL["op4_mixing"], sf)
