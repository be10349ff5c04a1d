import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import minhash
from lakeloom.llm.graph import components
from lakeloom.llm.textkit import U, mix

from tests.oracle import same

from .conftest import WORDS, passage

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_of(rows, k):
    out = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        out[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    return out


def brute(rows, k=4, similarity=80):
    sets = sets_of([r for r in rows if r[0] is not None], k)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= similarity * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect() if r["doc_id"] is not None}


def test_signatures_estimate_similarity():
    pool = mix(np.arange(4000, dtype=U))
    errors = []
    for n in (8, 60, 400):
        for t in range(20):
            own = pool[t * 100 : t * 100 + n]
            a, b = np.unique(own[: int(n * 0.95)]), np.unique(own[int(n * 0.05) :])
            real = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            s = minhash.superminhash(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
            errors.append((s[0] == s[1]).mean() - real)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05


def test_empty_sets_have_no_ranks():
    s = minhash.superminhash(np.zeros(0, U), np.array([0, 0]))
    assert (s == np.iinfo(np.uint64).max).all()


def edited(r, words, n):
    x = list(words)
    for _ in range(n):
        i = r.randrange(len(x))
        x[i : i + 1] = r.choice([[], [r.choice(WORDS) + "x"], [x[i], r.choice(WORDS)]])
    return " ".join(x)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(documents, odd_rows, seed):
    """Groups with and without their origin, copies of copies, cut texts, and groups that only share lines."""
    r = random.Random(seed)
    rows = []
    for g in range(6):
        origin = passage(g * 50 + seed, r.choice([12, 40, 90])).split()
        texts = [" ".join(origin)] if g % 2 else []
        for _ in range(25):
            texts.append(edited(r, origin, r.randint(1, 4)))
        for _ in range(15):
            texts.append(edited(r, r.choice(texts).split(), r.randint(0, 2)))
        for _ in range(8):
            cut = r.randint(0, len(origin) // 2)
            texts.append(edited(r, origin[cut:], r.randint(0, 2)))
        rows += [(g * 1000 + i, t.upper() if i % 5 == 0 else t) for i, t in enumerate(texts)]
    rows += [(9000 + (i or 0), t) for i, t in odd_rows if i] + [(None, rows[0][1]), (None, None)]
    r.shuffle(rows)
    frame = documents(rows).withColumn("band", F.lit(1)).withColumn("k1", F.lit("x"))
    got = minhash.near_dups(frame, k=4, similarity=80)
    assert got.count() == len(rows) and got.filter("doc_id IS NULL AND NOT kept").count() == 0
    assert found(got) == brute(rows)


def test_copies_and_empty(documents):
    assert minhash.near_dups(documents([])).count() == 0
    got = found(minhash.near_dups(documents([(i, passage(1, 50)) for i in range(60)] + [(100, ""), (101, None)])))
    assert {v[1] for k, v in got.items() if k < 60} == {0} and got[100] == (0, 100, True) and got[101] == (0, 101, True)


def test_one_id_with_several_texts(documents):
    """A doc_id is one node: it links whatever any of its texts links."""
    a, b, c, d = (passage(i, 40) for i in range(4))
    rows = [(3, a), (7, a), (7, b), (9, b), (9, b), (9, ""), (20, c), (21, d), (21, c.upper()), (22, d + " more"), (30, passage(5, 40)), (30, None), (3, passage(6, 40)), (40, passage(6, 41)), (50, None), (50, "")]
    got = minhash.near_dups(documents(rows)).collect()
    assert len(got) == len(rows)
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(3, 3), (7, 3), (9, 3), (20, 20), (21, 20), (22, 20), (30, 30), (40, 3), (50, 50)}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_components(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(r.randrange(100, 200), r.randrange(100, 200)) for _ in range(70)] + [(5, 5)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "u long, v long").repartition(7)).collect()}
    want = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_query(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert found(minhash.op7_minhash(spark, sf)) == brute(rows)


def test_sql(spark, sf):
    same(minhash.op7_minhash(spark, sf), minhash.SQL["op7_minhash"], sf)
