"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are normalised: lower case, runs of blanks made one space. An item of m code points
may differ by k = max(1, m * ``ERRORS`` // 100) edits; it is cut into k + 1 pieces, one of which every
occurrence must hold unchanged. One automaton finds all pieces in a text in one pass; each hit names
a window, and Myers' bit-parallel distance decides whether the item ends in it within k edits.

Items shorter than ``SHORT`` have no budget: they must stand unchanged, with a blank or an end of the text
on both sides, as a few edits would make any text of them.

Items are taken in blocks: the number of blocks follows the items' total length, so what the driver holds,
and the automaton a task receives, is bounded by about ``BLOCK_CHARS`` code points whatever the benchmark's
size. Every block is held against all texts; with several blocks each one's result is a saved table before
the next is read, so only one block is in memory at a time. Items that normalise to the same text share
one search. A worker process keeps the automaton of its last block for its next tasks.

Nulls and edge cases: NULL texts hold nothing; items that are NULL or blank are skipped, as are rows
without item_id; repeated rows give repeated matches; an empty documents or benchmark table gives no
matches. Extra columns pass through ``clean``. The automaton is that of the package pyahocorasick.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import forget, saved, small_batches, table
from .textkit import slices

ERRORS, SHORT, BLOCK_CHARS = 8, 40, 4_000_000


def normalised(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(m: int, errors: int = ERRORS) -> int:
    """Edits that an item of m code points may have."""
    return max(1, m * errors // 100) if m >= SHORT else 0


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces of near-equal length with their places."""
    n, m = k + 1, len(item)
    return [(i * m // n, item[i * m // n : (i + 1) * m // n]) for i in range(n)]


def masks(item: str) -> dict[str, int]:
    out: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        out[c] |= 1 << i
    return dict(out)


def search(eq: dict[str, int], m: int, window: str) -> tuple[int, int]:
    """The least edit distance of the item to a part of the window, and the first end of such a part (Myers 1999)."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(window):
        x = eq.get(c, 0)
        xh = (((x & pv) + pv) ^ pv) | x
        xv = x | mv
        ph, mh = mv | (~(xh | pv) & full), pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph, mh = (ph << 1) & full, (mh << 1) & full
        pv, mv = mh | (~(xv | ph) & full), ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    """All items of a block: item ids by normalised text."""

    def __init__(self, items: list[tuple[int, str]], errors: int):
        by_text: dict[str, list[int]] = defaultdict(list)
        for i, t in items:
            by_text[t].append(i)
        self.items = [(t, sorted(ids), budget(len(t), errors)) for t, ids in sorted(by_text.items())]
        self.masks: dict[int, tuple[dict, dict]] = {}
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for n, (t, _, k) in enumerate(self.items):
            for at, piece in pieces(t, k):
                places[piece].append((n, at))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def find(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item, distance, start, end) of the best occurrence of each item; places in the normalised text."""
        if not len(self.automaton):
            return
        starts: dict[int, list[int]] = defaultdict(list)
        for end, (size, where) in self.automaton.iter(text):
            for n, at in where:
                starts[n].append(end + 1 - size - at)
        for n, found in starts.items():
            item, ids, k = self.items[n]
            best = None
            found.sort()
            if len(item) < SHORT:
                alone = (at for at in found if (not at or text[at - 1] == " ") and text[at + len(item) : at + len(item) + 1] in ("", " "))
                if (at := next(alone, None)) is not None:
                    best = (0, at, at + len(item))
                found = []
            i = 0
            while i < len(found):
                # windows that overlap are searched as one
                j = i
                while j + 1 < len(found) and found[j + 1] - found[j] <= 2 * k:
                    j += 1
                lo, hi = max(0, found[i] - k), found[j] + len(item) + 2 * k
                i = j + 1
                window = text[lo:hi]
                exact = window.find(item)
                if exact >= 0:
                    best = (0, lo + exact, lo + exact + len(item))
                    break
                if n not in self.masks:
                    self.masks[n] = masks(item), masks(item[::-1])
                distance, end = search(self.masks[n][0], len(item), window)
                if distance <= k and (best is None or distance < best[0]):
                    back, size = search(self.masks[n][1], len(item), window[max(0, end - len(item) - k) : end][::-1])
                    best = (distance, lo + end - size, lo + end)
            if best:
                for x in ids:
                    yield (x, *best)


def blocks(benchmark: DataFrame) -> tuple[DataFrame, int]:
    """The items (item_id, text, block) that can be sought, and the number of blocks."""
    items = benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long"), "text")
    total = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    n = max(1, -(-total // BLOCK_CHARS)) if total else 0
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(n, 1)))
    dealt = items.withColumn("block", block)
    return (saved(dealt, "items", ["block"]) if n > 1 else dealt), n


def items_of(items: DataFrame, block: int) -> list[tuple[int, str]]:
    """One block's items, normalised."""
    known = [(r["item_id"], normalised(r["text"])) for r in items.filter(F.col("block") == block).select("item_id", "text").toLocalIterator()]
    return [(i, t) for i, t in known if t]


_last: dict = {}


def matcher_of(shared: Broadcast, errors: int) -> Matcher:
    """The matcher of a broadcast block; built once in a worker process."""
    if _last.get("made_of") != (shared.value, errors):
        _last.update(made_of=(shared.value, errors), matcher=Matcher(shared.value, errors))
    return _last["matcher"]


MATCHES = "item_id long, distance int, start long, end long"


def matches(docs: DataFrame, benchmark: DataFrame, errors: int = ERRORS) -> DataFrame:
    """doc_id, item_id, distance, start, end of each item found in each row of docs (doc_id, text)."""
    spark = docs.sparkSession
    small_batches(spark)
    items, n = blocks(benchmark)
    found = []
    for block in range(n):
        shared = spark.sparkContext.broadcast(items_of(items, block))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            m = matcher_of(shared, errors)
            for whole in batches:
                for b in slices(whole, "text"):
                    rows = [(doc, *x) for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True) if text for x in m.find(normalised(text))]
                    if rows:
                        d, i, e, s, t = zip(*rows, strict=True)
                        yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(i, pa.int64()), pa.array(e, pa.int32()), pa.array(s, pa.int64()), pa.array(t, pa.int64())], ["doc_id", "item_id", "distance", "start", "end"])

        new = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"doc_id long, {MATCHES}")
        if n > 1:
            new = saved(new, "matches")
            shared.destroy()
        found.append(new)
    return reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], f"doc_id long, {MATCHES}")


def clean(docs: DataFrame, benchmark: DataFrame, errors: int = ERRORS) -> DataFrame:
    """The rows of docs that hold no item. Each row is judged by its own text, so nothing is shuffled."""
    spark = docs.sparkSession
    small_batches(spark)
    items, n = blocks(benchmark)
    for block in range(n):
        shared = spark.sparkContext.broadcast(items_of(items, block))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            m = matcher_of(shared, errors)
            for whole in batches:
                for b in slices(whole, "text"):
                    keep = [not text or next(m.find(normalised(text)), None) is None for text in b.column("text").to_pylist()]
                    yield b.filter(pa.array(keep, pa.bool_()))

        left = docs.mapInArrow(run, T.StructType(docs.schema.fields))
        if n > 1:
            left = saved(left, "clean")
            shared.destroy()
            if block:
                forget(docs)
        docs = left
    return docs


def op5_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL: dict[str, str] = {}
