"""Language-model scores by deleted interpolation of n-gram maximum-likelihood estimates.

P1(w) = a c(w) / N + (1 - a) / (V + 1); P2(w | v) mixes c(v, w) / c(v) with P1(w), and P3(w | u, v) mixes
c(u, v, w) / c(u, v) with P2(w | v). The share of each estimate depends on the bucket of its context's count
(one bucket for each count up to ``EXACT``, then one for each power of two); a context that was never seen has
share 0. Shares are learned by expectation-maximisation on the held-out counts of one fold of the training
texts, the lower order first: each of its tokens is taken out of the counts it is predicted from. A text's
tokens are its words and one end; ends also stand before the first word as its contexts.

Counts cover every training text. Tasks turn a few MB of texts at a time into blocks: the distinct word
hashes, and each token's place among them. Blocks ask the parts of the hash range for the counts of their
distinct words, pairs and triples, each once a block; a part sums all blocks' counts of a key and answers each
block, and the answers join the block again. The number of parts follows the tokens. A common key is asked
for by every block, so with more than ``FAN`` blocks a part's requests are dealt to groups of about FAN
blocks: groups sum their own requests, the groups' sums meet by part, and their totals go back the same way.
No table of the vocabulary is ever broadcast or collected; only the shares, N, V and histograms of (bucket,
two estimates in quarter powers of two), bounded by the number of their cells, reach the driver.

Nulls and edge cases: a NULL or blank text is the end token alone; without training texts the score
is the base score; repeated rows count and score each; a NULL doc_id counts as the empty text when folds
are drawn; an empty table gives no rows. Extra columns are ignored. Words are told apart by 64 bits of hash, pairs
and triples by so many more than the tokens' number has that one in 16 million is expected to meet another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import CRC_SQL, LOWER, UPPER, crc_fold, crc_sql, release, saved, shuffle_parts, small_batches, table
from .textkit import FACTORS, U, buffers, hash_words, lowered, mix, pack, pack_keys, part_of, slices, unpack, unpack_keys

FOLDS, DELETED = 10, 1
#: Bytes of text in a block, tokens for each part of the hash range, and blocks in a group of a part's requests.
BLOCK, PART, FAN = 4 << 20, 2_000_000, 4096
ORDERS = 3
EXACT, BUCKETS = 8, 64
_END = U(0x5D1E0F3A9B7C2461)

BLOCKS = "block long, deleted boolean, tokens long, docs binary, folds binary, ends binary, places binary, words binary"


def blocks(docs: DataFrame) -> DataFrame:
    """Texts (doc_id, fold, text) as blocks; texts of the deleted fold have blocks of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for whole in batches:
            folds = whole.column("fold").to_numpy()
            for deleted in (False, True):
                for b in slices(whole.filter(pa.array((folds == DELETED) == deleted)), "text", BLOCK):
                    data, offsets = buffers(b.column("text"))
                    words, at = hash_words(lowered(data), offsets)
                    ends = at[1:] + np.arange(1, len(at))
                    tokens = np.full(len(words) + b.num_rows, _END, U)
                    inside = np.ones(len(tokens), bool)
                    inside[ends - 1] = False
                    tokens[inside] = words
                    known, place, often = np.unique(tokens, return_inverse=True, return_counts=True)
                    order = np.argsort(-often, kind="stable")
                    rank = np.empty(len(order), np.uint32)
                    rank[order] = np.arange(len(order), dtype=np.uint32)
                    ids = b.column("doc_id").to_numpy(zero_copy_only=False)
                    missing = np.asarray(b.column("doc_id").is_null())
                    row = [number, deleted, len(tokens), pack(np.where(missing, 0, ids).astype(np.int64)), pack(np.where(missing, -1, b.column("fold").to_numpy()).astype(np.int8)), pack(ends.astype(np.int64)), pack(rank[place]), known[order].tobytes()]
                    number += 1
                    yield pa.RecordBatch.from_pylist([dict(zip(("block", "deleted", "tokens", "docs", "folds", "ends", "places", "words"), row, strict=True))], pa.schema([("block", pa.int64()), ("deleted", pa.bool_()), ("tokens", pa.int64()), *[(c, pa.binary()) for c in ("docs", "folds", "ends", "places", "words")]]))

    return docs.mapInArrow(run, BLOCKS)


def bits_of(tokens: int) -> tuple[int, ...]:
    """Bits of a key by order."""
    return (64, *[min(64, tokens.bit_length() + 24)] * (ORDERS - 1))


class _Block:
    """A block's row, unpacked; by order, its distinct keys in ascending order and each token's place among them."""

    def __init__(self, bits: tuple[int, ...], folds: bytes, ends: bytes, places: bytes, words: bytes):
        self.folds, self.ends = unpack(folds, np.int8), unpack(ends, np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]])
        known, rank = np.frombuffer(words, U), unpack(places, np.uint32)
        order = np.argsort(known)
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        known, word = known[order], back[rank]
        # a NULL doc_id has fold -1 here; its fold as the empty text is 0, so it is not trained on
        self.trained = np.repeat(self.folds > 0, np.diff(self.ends, prepend=0))
        # the token before a text's first one is an end, its own or that of the text before
        self.before = np.roll(word, 1)
        earlier = np.roll(word, 2)
        earlier[self.starts] = self.before[self.starts]
        first = mix(known * FACTORS[0])
        then = known * FACTORS[1]
        pairs = mix(first[self.before] + then[word]) >> U(64 - bits[1])
        triples = mix(mix(first[earlier] + then[self.before]) + known[word] * FACTORS[2]) >> U(64 - bits[2])
        self.keys, self.of = [known], [word]
        for made in (pairs, triples):
            keys, of = np.unique(made, return_inverse=True)
            self.keys.append(keys)
            self.of.append(of)

    def counts(self, answers: list[dict]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """By order, each token's count and its context's; the context of a word alone has no count."""
        found = []
        for kind, of in enumerate(self.of):
            own = sorted((a["part"], a["n"]) for a in answers if a["kind"] == kind)
            found.append(np.concatenate([unpack(n, U) for _, n in own]).astype(np.int64))
        counts = [n[of] for n, of in zip(found, self.of, strict=True)]
        context = found[0][self.before]
        two = np.roll(counts[1], 1)
        two[self.starts] = context[self.starts]
        return counts, [np.zeros(0, np.int64), context, two]


ASKED = "kind int, part int, crowd int, block long, keys binary, n binary"


def asked(made: DataFrame, bits: tuple[int, ...], parts: int, crowds: int) -> DataFrame:
    """Each block's distinct keys with its own training counts, by the parts it has keys in. A block is in one crowd."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number, *columns in zip(*(b.column(c).to_pylist() for c in ("block", "folds", "ends", "places", "words")), strict=True):
                x = _Block(bits, *columns)
                crowd = int(mix(np.array([number], U))[0] % U(crowds))
                for kind, (keys, of) in enumerate(zip(x.keys, x.of, strict=True)):
                    n = np.bincount(of[x.trained], minlength=len(keys)).astype(U)
                    part = part_of(keys, parts, bits[kind])
                    cuts = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(keys))
                    rows = [(kind, part[i], crowd, number, pack_keys(keys[i:j]), pack(n[i:j])) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], [c.split()[0] for c in ASKED.split(", ")])

    return made.mapInArrow(run, ASKED)


ANSWER = "kind int, part int, crowd int, block long, n binary, total long, distinct long"


def _summed(keys: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The distinct keys, their sums, and each list's places among them."""
    known, which = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.zeros(len(known), U)
    np.add.at(sums, which, np.concatenate(n))
    return known, sums, np.split(which, np.cumsum([len(x) for x in keys])[:-1])


def _table(rows: list[tuple], kinds: str) -> pa.Table:
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    names = [c.split() for c in kinds.split(", ")]
    return pa.table({name: pa.array([r[i] for r in rows], types[kind]) for i, (name, kind) in enumerate(names)})


def _lists(group: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray]]:
    return [unpack_keys(x) for x in group.column("keys").to_pylist()], [unpack(x, U) for x in group.column("n").to_pylist()]


def answers(requests: DataFrame, crowds: int) -> DataFrame:
    """For each request the keys' counts over all blocks; total and distinct stand in one row of each part."""

    def answer(group: pa.Table) -> pa.Table:
        kind, part, crowd = (group.column(c)[0].as_py() for c in ("kind", "part", "crowd"))
        _, sums, places = _summed(*_lists(group))
        rows = [(kind, part, crowd, block, pack(sums[p]), 0, 0) for block, p in zip(group.column("block").to_pylist(), places, strict=True)]
        rows[0] = (*rows[0][:5], int(sums.sum(dtype=np.int64)), int((sums > 0).sum()))
        return _table(rows, ANSWER)

    if crowds == 1:
        return requests.groupBy("kind", "part").applyInArrow(answer, ANSWER)

    placed = "kind int, part int, crowd int, block long, keys binary, n binary"

    def crowd_sums(group: pa.Table) -> pa.Table:
        """The crowd's sums, as a row without block, and each block's places among them, as keys."""
        kind, part, crowd = (group.column(c)[0].as_py() for c in ("kind", "part", "crowd"))
        known, sums, places = _summed(*_lists(group))
        rows = [(kind, part, crowd, None, pack_keys(known), pack(sums))]
        rows += [(kind, part, crowd, block, pack_keys(p.astype(U)), b"") for block, p in zip(group.column("block").to_pylist(), places, strict=True)]
        return _table(rows, placed)

    def totals(group: pa.Table) -> pa.Table:
        kind, part = (group.column(c)[0].as_py() for c in ("kind", "part"))
        _, sums, places = _summed(*_lists(group))
        rows = [(kind, part, crowd, None, pack(sums[p]), 0, 0) for crowd, p in zip(group.column("crowd").to_pylist(), places, strict=True)]
        rows[0] = (*rows[0][:5], int(sums.sum(dtype=np.int64)), int((sums > 0).sum()))
        return _table(rows, ANSWER)

    def back(own: pa.Table, total: pa.Table) -> pa.Table:
        kind, part, crowd, _, n, whole, distinct = (total.column(c)[0].as_py() for c in [c.split()[0] for c in ANSWER.split(", ")])
        sums = unpack(n, U)
        rows = [(kind, part, crowd, block, pack(sums[unpack_keys(keys).astype(np.int64)]), 0, 0) for block, keys in zip(own.column("block").to_pylist(), own.column("keys").to_pylist(), strict=True)]
        rows[0] = (*rows[0][:5], whole, distinct)
        return _table(rows, ANSWER)

    first = saved(requests.groupBy("kind", "part", "crowd").applyInArrow(crowd_sums, placed), "lm-crowds")
    met = first.filter("block IS NULL").groupBy("kind", "part").applyInArrow(totals, ANSWER)
    keys = ["kind", "part", "crowd"]
    return first.filter("block IS NOT NULL").groupBy(*keys).cogroup(met.groupBy(*keys)).applyInArrow(back, ANSWER)


def _answered(made: DataFrame, found: DataFrame) -> DataFrame:
    """Blocks with the list of their answers."""
    own = found.groupBy("block").agg(F.collect_list(F.struct("kind", "part", "n")).alias("answers"))
    return made.join(own, "block")


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0: never seen; the count up to EXACT; then one more for each power of two."""
    power = np.frexp(np.maximum(context, 1).astype(float))[1] - np.frexp(float(EXACT))[1]
    return np.where(context <= EXACT, context, np.minimum(EXACT + 1 + power, BUCKETS - 1)).astype(np.int64)


def blend(shares: np.ndarray, count: np.ndarray, context: np.ndarray, below: np.ndarray) -> np.ndarray:
    own = shares[bucket_of(context)]
    return own * count / np.maximum(context, 1) + (1 - own) * below


class Shares:
    """By order, each bucket's share of its estimate; the rest falls to the order below."""

    def __init__(self, total: int, distinct: int):
        self.total, self.distinct = total, distinct
        self.one, self.more = 0.5, []

    def probability(self, counts: list[np.ndarray], contexts: list[np.ndarray], total: int) -> np.ndarray:
        """By as many orders as have been learned."""
        p = self.one * counts[0] / max(total, 1) + (1 - self.one) / (self.distinct + 1)
        for k, shares in enumerate(self.more, 1):
            p = blend(shares, counts[k], contexts[k], p)
        return p


CELLS = "bucket long, qu long, ql long, n long, su double, sl double"


def _cells(answered: DataFrame, bits: tuple[int, ...], shares: Shares, order: int) -> tuple[np.ndarray, ...]:
    """Held-out tokens by bucket and by both estimates, the order's own and the mix below, in quarter powers of two: bucket, n and the estimates' means."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for found, *columns in zip(*(b.column(c).to_pylist() for c in ("answers", "folds", "ends", "places", "words")), strict=True):
                x = _Block(bits, *columns)
                if not x.trained.any():
                    continue
                counts, contexts = ([c[x.trained] - 1 if len(c) else c for c in part] for part in x.counts(found))
                total = shares.total - 1
                if order:
                    below = shares.probability(counts, contexts, total)
                    upper, bucket = counts[order] / np.maximum(contexts[order], 1), bucket_of(contexts[order])
                else:
                    upper, below, bucket = counts[0] / max(total, 1), np.full(len(counts[0]), 1 / (shares.distinct + 1)), np.ones(len(counts[0]), np.int64)
                q = [np.where(f > 0, np.floor(4 * np.log2(np.maximum(f, 1e-300))), 1).astype(np.int64) for f in (upper, below)]
                keys, which = np.unique(np.stack([bucket, *q], 1), axis=0, return_inverse=True)
                which = which.reshape(-1)
                out = [*keys.T, np.bincount(which), np.bincount(which, upper), np.bincount(which, below)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], [c.split()[0] for c in CELLS.split(", ")])

    cells = answered.mapInArrow(run, CELLS).groupBy("bucket", "qu", "ql").agg(F.sum("n").alias("n"), F.sum("su").alias("su"), F.sum("sl").alias("sl")).toArrow()
    n = cells["n"].to_numpy().astype(float)
    return cells["bucket"].to_numpy(), n, cells["su"].to_numpy() / n, cells["sl"].to_numpy() / n


def learn(bucket: np.ndarray, n: np.ndarray, upper: np.ndarray, lower: np.ndarray, rounds: int = 80) -> np.ndarray:
    """Each bucket's share of the upper estimate by expectation-maximisation, with one pseudo-token for either side; bucket 0 has none."""
    out = np.full(BUCKETS, 0.5)
    held = np.bincount(bucket, n, minlength=BUCKETS)
    for _ in range(rounds):
        own = out[bucket] * upper
        due = n * own / np.maximum(own + (1 - out[bucket]) * lower, 1e-300)
        out = (np.bincount(bucket, due, minlength=BUCKETS) + 1) / (held + 2)
    out[0] = 0
    return out


def learned(answered: DataFrame, bits: tuple[int, ...], total: int, distinct: int) -> Shares:
    """The shares of all orders, the lowest first."""
    shares = Shares(total, distinct)
    shares.one = float(learn(*_cells(answered, bits, shares, 0))[1])
    for order in range(1, ORDERS):
        shares.more.append(learn(*_cells(answered, bits, shares, order)))
    return shares


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame) -> DataFrame:
    """The scores of docs (doc_id, text); texts whose fold is 0 are held out of all counts."""
    spark = docs.sparkSession
    small_batches(spark)
    made = saved(blocks(docs.select(F.col("doc_id").cast("long"), crc_fold("doc_id", FOLDS).cast("int").alias("fold"), "text")), "lm-blocks")
    tokens, n_blocks = made.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.count("*")).first()
    parts = int(min(1 << 30, max(shuffle_parts(spark), tokens // PART + 1)))
    crowds, bits = max(1, -(-n_blocks // FAN)), bits_of(tokens)
    found = saved(answers(asked(made, bits, parts, crowds), crowds), "lm-counts")
    release(spark)
    total, distinct = found.filter("kind = 0").agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    deleted = made.filter("deleted")
    shares = learned(saved(_answered(deleted, found.join(deleted.select("block"), "block", "left_semi")), "lm-deleted"), bits, total, distinct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for own, ids, *columns in zip(*(b.column(c).to_pylist() for c in ("answers", "docs", "folds", "ends", "places", "words")), strict=True):
                x = _Block(bits, *columns)
                counts, contexts = x.counts(own)
                base = np.log10((counts[0] + 0.1) / (total + 0.1 * (distinct + 1)))
                full = np.log10(shares.probability(counts, contexts, total)) if total else base
                held = pa.array(x.folds <= 0)
                out = [pa.array(unpack(ids, np.int64), mask=x.folds < 0), held, pa.array(x.ends - x.starts), pa.array(np.add.reduceat((counts[0] > 0).astype(np.int64), x.starts)), pa.array(np.full(len(x.starts), total)), pa.array(np.add.reduceat(base, x.starts)), pa.array(np.add.reduceat(full, x.starts))]
                yield pa.RecordBatch.from_arrays(out, [c.split()[0] for c in SCORES.split(", ")])

    return _answered(made, found).mapInArrow(run, SCORES)


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))


def lm_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can tell of op10_lm's rows."""
    return op10_lm(spark, sf_dir).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 4).alias("base_score"))


SQL = {
    "lm_counts": f"""
WITH RECURSIVE {CRC_SQL},
w AS (SELECT doc_id, list_append(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+'), '') AS ws, {crc_sql('doc_id')} % {FOLDS} AS fold FROM documents CROSS JOIN crc_table),
t AS (SELECT doc_id, fold, unnest(ws) AS x FROM w),
c AS (SELECT x, count(*) AS c FROM t WHERE fold <> 0 GROUP BY x),
n AS (SELECT sum(c) AS n, count(*) AS v FROM c),
each AS (SELECT doc_id, fold, coalesce(c, 0) AS c FROM t LEFT JOIN c USING (x))
SELECT doc_id, fold = 0 AS held_out, count(*)::BIGINT AS n_tokens, (count(*) FILTER (c > 0))::BIGINT AS n_known, any_value(n)::BIGINT AS train_tokens,
  round(sum(log10((c + 0.1::DOUBLE) / (n + 0.1::DOUBLE * (v + 1)))), 4) AS base_score FROM each CROSS JOIN n GROUP BY doc_id, fold"""
}
