import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lakeloom.llm import lm

from tests.oracle import same

from .conftest import passage

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(i):
    return zlib.crc32(str(i).encode() if i is not None else b"") % 10


def tokens(t):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)), None]


def bucket(c):
    """Own bucket for each count up to 8, then one for each power of two."""
    return c if c <= 8 else 9 + int(math.log2(c)) - 3


def grams(w):
    """(u, v, w) of each token of a text."""
    padded = [None, None, *w]
    return list(zip(padded, padded[1:], w, strict=False))


def shares_of(seen):
    """(upper, lower, bucket) of held-out tokens: the shares that expectation-maximisation ends in, one pseudo-token a side."""
    by = {}
    for u, x, b in seen:
        by.setdefault(b, []).append((u, x))
    out = {}
    for b, own in by.items():
        share = 0.5
        for _ in range(80):
            due = sum(share * u / (share * u + (1 - share) * x) for u, x in own)
            share = (due + 1) / (len(own) + 2)
        out[b] = share
    return out | {0: 0.0}


def brute(rows):
    """Counts and scores from dictionaries."""
    texts = [(i, tokens(t)) for i, t in rows]
    one, two, three = Counter(), Counter(), Counter()
    for i, w in texts:
        if fold(i):
            one.update(w)
            two.update((v, x) for _, v, x in grams(w))
            three.update(grams(w))
    total, distinct = sum(one.values()), len(one)
    # the pair of ends before a first word occurs once a text, as the end does
    pair = lambda u, v, first: one[None] if first else two[u, v]
    cells = [(three[g] - 1, pair(*g[:2], n == 0) - 1, two[g[1:]] - 1, one[g[1]] - 1, one[g[2]] - 1) for i, w in texts if fold(i) == lm.DELETED for n, g in enumerate(grams(w))]
    low = shares_of([(c[4] / max(total - 1, 1), 1 / (distinct + 1), 1) for c in cells]).get(1, 0.5)
    p1 = lambda c, n: low * c / max(n, 1) + (1 - low) / (distinct + 1)
    s2 = shares_of([(c[2] / max(c[3], 1), p1(c[4], total - 1), bucket(c[3])) for c in cells])
    mixed = lambda shares, c, h, below: (a := shares.get(bucket(h), 0.5)) * c / max(h, 1) + (1 - a) * below
    s3 = shares_of([(c[0] / max(c[1], 1), mixed(s2, c[2], c[3], p1(c[4], total - 1)), bucket(c[1])) for c in cells])
    out = []
    for i, w in texts:
        base = sum(math.log10((one[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in w)
        own = sum(math.log10(mixed(s3, three[g], pair(*g[:2], n == 0), mixed(s2, two[g[1:]], one[g[1]], p1(one[g[2]], total)))) for n, g in enumerate(grams(w))) if total else base
        out.append((i, fold(i) == 0, len(w), sum(one[x] > 0 for x in w), total, base, own))
    return sorted(out, key=repr)


def check(df, rows):
    key = lambda r: (str(r[0]), r[2], r[5])
    got, want = sorted((tuple(r) for r in df.collect()), key=key), sorted(brute(rows), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=0.003)


def test_against_brute_force(documents, odd_rows):
    rows = [(i, passage(i % 40, 60)) for i in range(100, 220)] + odd_rows
    check(lm.score(documents(rows)), rows)


def test_few_rows(documents):
    assert lm.score(documents([])).count() == 0
    held = next(i for i in range(100) if fold(i) == 0)
    row = lm.score(documents([(held, "a b")])).first()
    assert row["train_tokens"] == 0 and row["n_known"] == 0 and row["score"] == row["base_score"]


def test_extra_columns(documents, odd_rows):
    rows = [(i, passage(i % 7, 20)) for i in range(30)] + odd_rows
    frame = documents(rows)
    for c in ("score", "block", "fold", "part", "n", "answers", "words"):
        frame = frame.withColumn(c, frame["lang"])
    assert sorted(map(str, lm.score(frame).collect())) == sorted(map(str, lm.score(documents(rows)).collect()))


def near(df):
    return sorted(((*r[:5], round(r[5], 9), round(r[6], 6)) for r in df.collect()), key=str)


def test_parts_and_crowds_do_not_matter(documents, monkeypatch):
    """A part's requests may be dealt to any number of groups, some of them with one block only."""
    rows = [(i, passage(i, 40)) for i in range(60)]
    one = near(lm.score(documents(rows).repartition(6)))
    monkeypatch.setattr(lm, "PART", 50)
    assert near(lm.score(documents(rows).repartition(6))) == one
    monkeypatch.setattr(lm, "FAN", 2)
    assert near(lm.score(documents(rows).repartition(12))) == one


def test_copies_score_apart(documents):
    """Texts that occur twice are likelier than texts that occur once, in the counts and held out."""
    rows = [(i, passage(i if i % 4 else i - i % 8, 60)) for i in range(400)]
    often = Counter(t for _, t in rows)
    text = dict(rows)
    got = [(often[text[r["doc_id"]]], r["held_out"], r["score"] / r["n_tokens"]) for r in lm.score(documents(rows)).collect()]
    for held in (False, True):
        once, twice = ([x for n, h, x in got if h == held and n == k] for k in (1, 2))
        assert twice and np.median(twice) > np.quantile(once, 0.9)


def test_packing():
    for x in (np.zeros(0, np.uint32), np.arange(1000, dtype=np.uint32) * 77, np.array([-1, 5], np.int8)):
        assert (lm.unpack(lm.pack(x), x.dtype) == x).all()
    keys = np.sort(np.arange(5, 900, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    assert (lm.unpack_keys(lm.pack_keys(keys)) == keys).all() and (lm.unpack_keys(lm.pack_keys(keys[:1])) == keys[:1]).all()


def test_shares():
    w = lm.learn(np.array([3, 3, 5]), np.array([5.0, 1, 2]), np.array([0.5, 0, 0.1]), np.array([0.01, 0.02, 0.01]))
    assert w[0] == 0 and ((w[1:] > 0) & (w[1:] < 1)).all() and w[7] == 0.5 and w[3] > 0.6
    assert [int(x) for x in lm.bucket_of(np.array([0, 1, 8, 9, 15, 16, 31, 32]))] == [bucket(c) for c in (0, 1, 8, 9, 15, 16, 31, 32)]


def test_held_out_texts_do_better_than_the_base(spark, sf):
    got = lm.op10_lm(spark, sf).filter("held_out").toPandas()
    assert got["score"].sum() > got["base_score"].sum()


def test_sql(spark, sf):
    same(lm.lm_counts(spark, sf), lm.SQL["lm_counts"], sf)
