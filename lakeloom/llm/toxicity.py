"""Toxicity by class-conditional Kneser-Ney models over the letters of words.

Two models of one shape, toxic and ordinary, give each word's log-likelihood from its bytes: orders 1 to 5,
absolute discount, continuation counts below the top order (raw counts for grams that start a word, which
have no left neighbour). A word counts once a text, so that one text's own words don't make a class. The
orders up to ``SHARED`` use the counts of both classes together, and a gram of fewer than ``RARE`` in both
classes has no term of its own, so rare expressions fall back on shared counts and speak for neither class.

A text is told by its two log-likelihoods' difference, divided by its length in bytes; by the greatest such
difference of ``WINDOW`` words in a row, as a few words can make a long text toxic; and by its number of words,
since the greatest of more windows is greater by chance. A logistic curve over the three, fitted where each
text was told by models that hadn't seen it (each of three folds by the other two), gives the score.

Labels are read only where crc32(doc_id) mod 4 is not 2; the other remainders are the folds. The sample is
bounded by ``PER_CLASS`` labelled texts of each class, the first by md5 of doc_id, and weighted back to the
classes' sizes for the curve; grams are counted by Spark under exact keys, and the ``MOST`` most frequent ones
of an order make the model, whose size is thus bounded.

Nulls and edge cases: a NULL or wordless text scores the share of toxic labels in the sample; so does
every text if the sample lacks a class (0 without labels). Repeated rows score alike; a label that
repeats counts once, toxic if any says so; NULL labels are skipped; an empty table gives no rows. Extra
columns pass through ``score_texts``, which replaces a column that has the score's name already. Memory is
bounded by a few MB of text at a time, or one text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_fold, saved, small_batches, table
from .textkit import U, buffers, hash_words, mix, slices, word_spans

ORDERS, SHARED, RARE, DISCOUNT = 5, 2, 4, 0.75
WINDOW = 3
PER_CLASS, MOST = 10_000, 1 << 18
THRESHOLD = 0.3
HELD_OUT, FOLDS = 2, (0, 1, 3)
#: Letters of the alphabet: 256 bytes and the mark before and after a word.
LETTERS = 257
#: ASCII bytes that part words: all but digits and letters.
_PART = np.zeros(256, bool)
_PART[:48] = _PART[58:65] = _PART[91:97] = _PART[123:128] = True


class Lookup:
    """Values of exact keys: a key's slot tells whether it is known; keys that share a slot are in a list of their own."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(8, len(keys).bit_length() + 1)
        self.shift = U(64 - bits)
        slot = self._slot(keys)
        _, first = np.unique(slot, return_index=True)
        self.keys, self.at = np.full(1 << bits, -1, np.int64), np.full(1 << bits, len(keys), np.int32)
        self.keys[slot[first]], self.at[slot[first]] = keys[first], first
        late = np.setdiff1d(np.arange(len(keys)), first)
        late = late[np.argsort(keys[late])]
        self.late_keys, self.late_at = keys[late], late.astype(np.int32)
        self.crowded = np.zeros(1 << bits, bool)
        self.crowded[slot[late]] = True
        self.values = np.concatenate([values, np.zeros((1, values.shape[1]), values.dtype)])

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.view(U) + U(1)) >> self.shift).astype(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """A row of values for each key, zeros for unknown ones."""
        slot = self._slot(keys)
        at = np.where(self.keys[slot] == keys, self.at[slot], len(self.values) - 1)
        if len(self.late_keys):
            more = np.flatnonzero(self.crowded[slot] & (at == len(self.values) - 1))
            place = np.minimum(np.searchsorted(self.late_keys, keys[more]), len(self.late_keys) - 1)
            hit = self.late_keys[place] == keys[more]
            at[more[hit]] = self.late_at[place[hit]]
        return self.values[at]


@dataclass
class Model:
    """By order, the keys and both classes' shares of grams, and of contexts the shares that their grams take; the curve; the prior.

    Only these lists travel; a task makes lookups of them once.
    """

    grams: list[tuple[np.ndarray, np.ndarray]] | None
    contexts: list[tuple[np.ndarray, np.ndarray]] | None
    curve: tuple[float, ...] | None
    prior: float

    def lookups(self) -> tuple[list[Lookup], list[Lookup]]:
        if not hasattr(self, "_made"):
            self._made = [Lookup(*x) for x in self.grams], [Lookup(*x) for x in self.contexts]
        return self._made

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_made"}


def prepared(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = buffers(pc.utf8_lower(column))
    return np.where(_PART[data], np.uint8(32), data), offsets


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Of words with an end mark: the word of each letter, by order its gram's and its context's key, and the letter's place in the word.

    A key is the letters as digits of a number, so it is exact; the mark is 0.
    """
    sizes = ends - starts
    whole = sizes + ORDERS
    first = np.cumsum(whole) - whole
    padded = np.zeros(int(whole.sum()), np.int64)
    padded[_spread(first + ORDERS - 1, sizes)] = data[_spread(starts, sizes)].astype(np.int64) + 1
    at = _spread(first + ORDERS - 1, sizes + 1)
    word = np.repeat(np.arange(len(starts)), sizes + 1)
    place = at - first[word] - (ORDERS - 1)
    found, contexts = [padded[at]], [np.zeros(len(at), np.int64)]
    for k in range(1, ORDERS):
        contexts.append(contexts[-1] + padded[at - k] * LETTERS ** (k - 1))
        found.append(contexts[-1] * LETTERS + padded[at])
    return word, found, contexts, place


COUNTS = "k long, gram long, start boolean, fold long, toxic long, n long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """COUNTS rows of a batch of (toxic, fold, text): in how many texts' words the gram occurs, each word once a text."""
    for whole in batches:
        for b in slices(whole, "text", 1 << 20):
            data, offsets = prepared(b.column("text"))
            words, at = hash_words(data, offsets)
            if not len(words):
                continue
            starts, ends = word_spans(data, offsets)
            text = np.repeat(np.arange(b.num_rows), np.diff(at))
            _, first, which = np.unique(words, return_index=True, return_inverse=True)
            once = np.unique(text << 32 | which)
            kind = (b.column("fold").to_numpy(zero_copy_only=False).astype(np.int64) * 2 + b.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64))[once >> 32]
            word, found, _, place = grams(data, starts[first], ends[first])
            for c in np.unique(kind):
                n = np.bincount((once & 0xFFFFFFFF)[kind == c], minlength=len(first))
                for k in range(ORDERS):
                    keys, row = np.unique(found[k] * 2 + (place < k), return_inverse=True)
                    counts = np.bincount(row, n[word]).astype(np.int64)
                    keys, counts = keys[counts > 0], counts[counts > 0]
                    columns = [np.full(len(keys), k), keys >> 1, (keys & 1).astype(bool), np.full(len(keys), c >> 1), np.full(len(keys), c & 1), counts]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], [c.split()[0] for c in COUNTS.split(", ")])


def terms(seen: DataFrame) -> list[tuple[list, list]]:
    """The lists of one model for each fold left out, and of the one of all folds, from counted grams (COUNTS).

    A model's lists are, by order, of grams and of contexts, keys and both classes' shares. All models go through
    one plan, a pair of columns each.
    """
    outs = (*FOLDS, None)
    pairs = [(m, c) for m in range(len(outs)) for c in (0, 1)]
    each = lambda make: [make(f"n{m}{c}", m, c).alias(f"n{m}{c}") for m, c in pairs]
    summed = seen.groupBy("k", "gram", "start").agg(*each(lambda n, m, c: F.sum(F.when((F.col("toxic") == c) & (F.lit(outs[m] is None) | (F.col("fold") != F.lit(-1 if outs[m] is None else outs[m]))), F.col("n")).otherwise(0))))
    # raw counts at the top order and for grams that take in the mark before a word; kinds of left neighbours elsewhere
    raw = summed.filter((F.col("k") == ORDERS - 1) | F.col("start")).select("k", "gram", *each(lambda n, m, c: F.col(n)))
    inner = summed.filter((F.col("k") > 0) & (~F.col("start") | (F.col("k") == 1)))
    span = F.element_at(F.array(*[F.lit(LETTERS**k) for k in range(ORDERS)]), (F.col("k") + 1).cast("int"))
    continued = inner.groupBy((F.col("k") - 1).alias("k"), (F.col("gram") % span).alias("gram")).agg(*each(lambda n, m, c: F.count_if(F.col(n) > 0)))
    counts = raw.unionByName(continued).groupBy("k", "gram").agg(*each(lambda n, m, c: F.sum(n)))
    both = lambda m: F.col(f"n{m}0") + F.col(f"n{m}1")
    shared = counts.select("k", "gram", F.expr(f"gram div {LETTERS}").alias("ctx"), *each(lambda n, m, c: F.when(F.col("k") < SHARED, both(m)).otherwise(F.col(n))))
    totals = shared.groupBy("k", "ctx").agg(*[F.sum(f"n{m}{c}").alias(f"t{m}{c}") for m, c in pairs])
    pooled = summed.groupBy("k", "gram").agg(*[F.sum(both(m)).alias(f"p{m}") for m in range(len(outs))]).filter(F.col(f"p{len(outs) - 1}") >= RARE)
    share = lambda m, c: F.when((F.col(f"p{m}") >= RARE) & (F.col(f"n{m}{c}") > DISCOUNT), (F.col(f"n{m}{c}") - DISCOUNT) / F.col(f"t{m}{c}")).otherwise(0.0).cast("float").alias(f"a{m}{c}")
    last = f"p{len(outs) - 1}"
    kept = saved(shared.join(pooled, ["k", "gram"]).join(totals, ["k", "ctx"]).select("k", "gram", "ctx", last, *[share(m, c) for m, c in pairs]), "tox-terms")
    # at most MOST rows of a few numbers an order
    orders = [kept.filter(F.col("k") == k).orderBy(F.desc(last), "gram").limit(MOST).toArrow() for k in range(ORDERS)]
    out = []
    for m in range(len(outs)):
        grams_, contexts_ = [], []
        for rows in orders:
            values = np.stack([rows[f"a{m}{c}"].to_numpy() for c in (0, 1)], 1).astype(np.float32).reshape(-1, 2)
            known = values.any(1)
            key, values = rows["gram"].to_numpy()[known], values[known]
            contexts, which = np.unique(rows["ctx"].to_numpy()[known], return_inverse=True)
            grams_.append((key, values))
            contexts_.append((contexts, np.stack([np.bincount(which, values[:, c], minlength=len(contexts)) for c in (0, 1)], 1).astype(np.float32)))
        out.append((grams_, contexts_))
    return out


def word_evidence(model: Model, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """log P(word | toxic) - log P(word | ordinary)."""
    word, found, contexts, _ = grams(data, starts, ends)
    own, taken = model.lookups()
    p = np.full((len(word), 2), 1 / LETTERS)
    for k in range(ORDERS):
        p = own[k].of(found[k]) + np.maximum(1 - taken[k].of(contexts[k]), 1e-6) * p
    return np.bincount(word, np.log(p[:, 1]) - np.log(p[:, 0]), minlength=len(starts))


def evidence(model: Model, column: pa.Array) -> np.ndarray:
    """By text: the most of WINDOW words' length-normalised evidence, the whole text's, and log(1 + words); NaN without words."""
    data, offsets = prepared(column)
    words, at = hash_words(data, offsets)
    sizes = np.diff(at)
    out = np.full((len(sizes), 3), np.nan)
    if not len(words):
        return out
    starts, ends = word_spans(data, offsets)
    _, first, which = np.unique(words, return_index=True, return_inverse=True)
    own = word_evidence(model, data, starts[first], ends[first])[which]
    length = (ends - starts + 1).astype(float)
    total, bytes_ = np.concatenate([[0], np.cumsum(own)]), np.concatenate([[0], np.cumsum(length)])
    begin, n = np.repeat(at[:-1], sizes), np.repeat(sizes, sizes)
    last = np.arange(len(words)) + 1
    start = np.maximum(last - WINDOW, begin)
    mean = (total[last] - total[start]) / (bytes_[last] - bytes_[start])
    mean[last - begin < np.minimum(WINDOW, n)] = -np.inf
    filled = sizes > 0
    out[filled, 0] = np.maximum.reduceat(mean, at[:-1][filled])
    out[filled, 1] = ((total[at[1:]] - total[at[:-1]]) / np.maximum(bytes_[at[1:]] - bytes_[at[:-1]], 1))[filled]
    out[filled, 2] = np.log1p(sizes[filled])
    return out


def score_of(model: Model, found: np.ndarray) -> np.ndarray:
    if model.curve is None:
        return np.full(len(found), model.prior)
    z = np.clip(found @ np.array(model.curve[:-1]) + model.curve[-1], -30, 30)
    return np.where(np.isnan(z), model.prior, 1 / (1 + np.exp(-z)))


def fitted(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Slopes and shift of a weighted logistic fit by Newton's method, with a small ridge."""
    mean, scale = x.mean(0), x.std(0)
    scale[scale == 0] = 1.0
    m = np.concatenate([(x - mean) / scale, np.ones((len(x), 1))], 1)
    b = np.zeros(m.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(m @ b, -30, 30)))
        w = weight * p * (1 - p) + 1e-9
        step = np.linalg.solve(m.T @ (m * w[:, None]) + 1e-2 * np.eye(len(b)), m.T @ (weight * (y - p)) - 1e-2 * b)
        b += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    slopes = b[:-1] / scale
    return (*map(float, slopes), float(b[-1] - slopes @ mean))


def _told(texts: DataFrame, model: Model) -> DataFrame:
    """y, x0, x1, x2 of labelled texts (toxic, text)."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, "text", 1 << 20):
                x = evidence(shared.value, part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("toxic").cast(pa.int64()), *[pa.array(np.ascontiguousarray(c)) for c in x.T]], ["y", "x0", "x1", "x2"])

    return texts.select("toxic", "text").mapInArrow(run, "y long, x0 double, x1 double, x2 double")


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Fit on docs (doc_id, text) and labels (doc_id, toxic)."""
    small_batches(docs.sparkSession)
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    known = known.withColumn("fold", crc_fold("doc_id", 4)).filter(F.col("fold") != HELD_OUT).withColumn("key", F.md5(F.col("doc_id").cast("string")))
    first = lambda c: known.filter(F.col("toxic") == c).orderBy("key", "doc_id").limit(per_class)
    ids = saved(first(1).unionAll(first(0)).select(F.col("doc_id").alias("_id"), "toxic", "fold"), "tox-labels")
    whole = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    # at most 2 per_class rows
    sample = saved(docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("_id")).select("toxic", "fold", "text"), "tox-sample")
    counts = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    weight = {c: whole[c] / n for c, n in counts.items()}
    prior = sum(weight[c] * n for c, n in counts.items() if c) / max(sum(weight[c] * n for c, n in counts.items()), 1)
    if len(counts) < 2:
        return Model(None, None, None, float(prior))
    seen = saved(sample.mapInArrow(_count, COUNTS).groupBy("k", "gram", "start", "fold", "toxic").agg(F.sum("n").alias("n")), "tox-grams")
    *folded, final = terms(seen)
    told = [_told(sample.filter(F.col("fold") == f), Model(*lists, None, prior)) for f, lists in zip(FOLDS, folded, strict=True)]
    # a row of four numbers for each text of the sample
    rows = told[0].unionAll(told[1]).unionAll(told[2]).toArrow()
    x, y = np.stack([rows[c].to_numpy() for c in ("x0", "x1", "x2")], 1), rows["y"].to_numpy().astype(float)
    keep = ~np.isnan(x[:, 0])
    model = Model(*final, None, float(prior))
    if keep.sum() and 0 < y[keep].sum() < keep.sum():
        model.curve = fitted(x[keep], y[keep], np.where(y[keep] > 0, weight[1], weight[0]))
    return model


def score_texts(docs: DataFrame, model: Model, into: str = "score") -> DataFrame:
    """docs with the double column ``into`` from its column text."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c != into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for whole in batches:
            for b in slices(whole, "text", 1 << 20):
                found = np.full((b.num_rows, 3), np.nan) if m.curve is None else evidence(m, b.column("text"))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score_of(m, found))], [*b.schema.names, into])

    kept = docs.select(*names)
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(into, T.DoubleType())]))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = score_texts(docs, model)
    return scored.select("doc_id", (crc_fold("doc_id", 4) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


SQL: dict[str, str] = {}
