"""MinHash near-dedup: SuperMinHash signatures, banding, exact verification, union-find grouping.

A document's set holds its distinct runs of ``k`` words (A-Z lower-cased); a shorter text's whole
word sequence is its one element, and a text without words has the empty set. In SuperMinHash each
element visits the 252 slots in an order of its own with correlated ranks j + r; a text stops early,
once no slot can still fall. 42 bands of 6 slots miss a pair of similarity 0.8 with probability 3e-6.

Texts with one word sequence form one class; classes of like size that share a band form families. Each
member of a family is compared, by whole shingle sets, with a hub of its size, the member with most
company in the bands; two members that can link have a hub in common. What links with a hub is one
component. A pair (X, Y) in which Y doesn't link with hub H can still link. With c = (1 - t) / (1 + t) a
link needs |X ^ Y| <= c (|X| + |Y|), while |Y ^ H| > c (|Y| + |H|); so X ^ H and Y ^ H share
s > (|X ^ H| + c (|H| - |X|)) / 2 elements, and any |X ^ H| - s + 1 elements of X ^ H hold one of them.
Also Y holds at least t |X| elements of X, so any |X| - t |X| + 1 elements of X hold one of Y's. Each
member offers the rarest elements of either kind, whichever fewer others hold, and meets the unlinked
members that hold one. A meeting counts if sketches of X ^ H and Y ^ H, 512 bits with a bit for each
element, have enough in common: bits shared and elements that fell on a taken bit bound the shared
elements from above. What is left is compared by whole sets. So links between any two texts of a family
are found or ruled out, or lie within a component, without expanding the family into pairs.

Nulls and edge cases: NULL and blank texts link with nothing; a row with NULL doc_id links with
nothing and is kept; rows that share a doc_id are one node, whose texts' links are all its own, so they
have one component; an empty table gives no rows. Extra
columns are ignored. Sets are compared by 64-bit hashes of shingles. One text must fit in a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, forget, saved, small_batches, table
from .graph import components
from .textkit import FACTORS, U, buffers, combine, hash_words, lowered, mix, slices

SLOTS, BAND = 252, 6
SHINGLE, SIMILARITY = 5, 80
_GOLD = U(0x9E3779B97F4A7C15)
_TOP = np.iinfo(np.uint64).max
#: Elements whose slot orders are held at once.
ACTIVE = 1 << 16


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one text's word hashes."""
    if not len(words):
        return words
    return np.unique(combine(words, k) if len(words) >= k else combine(words, len(words)) ^ U(len(words)))


def _step(elements: np.ndarray, j: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Rank j + r, as j above 48 bits of r, and the slot j is swapped with, for each element."""
    x = mix(elements + U((j + 1) * int(_GOLD) % (1 << 64)))
    k = U(j) + (((mix(x) >> U(32)) * U(slots - j)) >> U(32))
    return (U(j) << U(48)) | (x >> U(16)), k.astype(np.int64)


def superminhash(elements: np.ndarray, offsets: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Signatures of the sets elements[offsets[i]:offsets[i+1]]; an empty set's slots hold the top value."""
    n = len(offsets) - 1
    out = np.full((n, slots), _TOP, U)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    rank, slot = _step(elements, 0, slots)
    np.minimum.at(out.reshape(-1), owner * slots + slot, rank)
    open_ = np.flatnonzero((out.max(1) >= U(1 << 48)) & (np.diff(offsets) > 0))
    at = 0
    while at < len(open_):
        sizes = np.cumsum(np.diff(offsets)[open_[at:]])
        take = max(1, int(np.searchsorted(sizes, ACTIVE, "right")))
        docs = open_[at : at + take]
        at += take
        own = np.concatenate([np.arange(offsets[d], offsets[d + 1]) for d in docs])
        e, o = elements[own], owner[own]
        order = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (len(e), 1))
        j = 0
        while len(e) and j < slots:
            rank, k = _step(e, j, slots)
            rows = np.arange(len(e))
            here = order[rows, k].copy()
            order[rows, k] = order[:, j]
            order[:, j] = here
            if j:
                np.minimum.at(out.reshape(-1), o * slots + here, rank)
            j += 1
            if j < slots:
                going = (out[docs].max(1) >> U(48)) >= U(j)
                live = np.zeros(n, bool)
                live[docs[going]] = True
                keep = live[o]
                if not keep.all():
                    e, o, order = e[keep], o[keep], order[keep]
    return out


def bands(signatures: np.ndarray, rows: int = BAND) -> np.ndarray:
    n, slots = signatures.shape
    parts = signatures.reshape(n, slots // rows, rows)
    total = np.zeros(parts.shape[:2], U)
    for i in range(rows):
        total = mix(total + parts[:, :, i] * FACTORS[i])
    return mix(total + np.arange(1, slots // rows + 1, dtype=U)[None, :] * _GOLD)


def _sequence_keys(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each text's word sequence."""
    place = np.arange(len(words)) - np.repeat(offsets[:-1], np.diff(offsets))
    placed = mix(words + mix(place.astype(U) + U(1)))
    out = []
    for salt in (U(0), _GOLD):
        total = np.zeros(len(words) + 1, U)
        np.cumsum(mix(placed ^ salt) if salt else placed, out=total[1:])
        out.append(total[offsets[1:]] - total[offsets[:-1]])
    return out[0], out[1]


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, t (the text's hash), n_shingles, k1, k2 (the word sequence's key) and bands of each row of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                data, offsets = buffers(b.column("text"))
                words, at = hash_words(lowered(data), offsets)
                sets = [shingles(words[i:j], k) for i, j in zip(at[:-1], at[1:], strict=True)]
                ends = np.zeros(len(sets) + 1, np.int64)
                np.cumsum([len(s) for s in sets], out=ends[1:])
                found = bands(superminhash(np.concatenate(sets), ends)) if len(sets) else np.zeros((0, SLOTS // BAND), U)
                k1, k2 = _sequence_keys(words, at)
                listed = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * found.shape[1]), pa.array(found.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("t"), pa.array(np.diff(ends)), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), listed], ["doc_id", "t", "n_shingles", "k1", "k2", "bands"])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("t"), "text").mapInArrow(run, "doc_id long, t long, n_shingles long, k1 long, k2 long, bands array<long>")


SKETCH = [f"s{i}" for i in range(8)]
COMPARED = "a long, b long, linked boolean, size long, need long, enough long, added array<long>, missing array<long>, " + ", ".join(f"{c} long" for c in SKETCH)


def sketch(elements: np.ndarray) -> np.ndarray:
    """512 bits as 8 numbers, a bit for each element."""
    bits = np.zeros(512, bool)
    bits[(mix(elements) >> U(55)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").view(np.int64)


def compared(pairs: DataFrame, texts: DataFrame, k: int, similarity: int) -> DataFrame:
    """Each pair (a, b) by whole shingle sets: linked, size (of a's set), and the elements added to b's and missing.

    Of added and missing, any ``need`` hold one that every text has alike which links with a, but not
    with b; any ``enough`` elements of a's set hold one of every text that links with a.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, other = None, None
        for whole in batches:
            for b in slices(whole, "ta", 4 << 20):
                data, offsets = buffers(b.column("ta"))
                words, at = hash_words(lowered(data), offsets)
                linked, sizes, needs, enough, added, missing, bits = [], [], [], [], [], [], []
                for i, hub in enumerate(b.column("b").to_pylist()):
                    if hub != known:
                        hd, ho = buffers(b.column("tb").slice(i, 1))
                        known, other = hub, shingles(hash_words(lowered(hd), ho)[0], k)
                    own = shingles(words[at[i] : at[i + 1]], k)
                    more, less = (np.setdiff1d(x, y, assume_unique=True) for x, y in ((own, other), (other, own)))
                    apart, both = len(more) + len(less), len(own) - len(more)
                    linked.append(both > 0 and 100 * both >= similarity * (both + apart))
                    # the least whole s above (apart + c (|other| - |own|)) / 2, c = (100 - similarity) / (100 + similarity)
                    shared = (apart * (100 + similarity) + (100 - similarity) * (len(other) - len(own))) // (2 * (100 + similarity)) + 1
                    sizes.append(len(own))
                    needs.append(min(apart, max(0, apart - shared + 1)))
                    enough.append(len(own) - -(-similarity * len(own) // 100) + 1)
                    added.append(more.view(np.int64))
                    missing.append(less.view(np.int64))
                    bits.append(sketch(np.concatenate([more, less])))
                lists = []
                for found in (added, missing):
                    ends = np.zeros(len(found) + 1, np.int32)
                    np.cumsum([len(x) for x in found], out=ends[1:])
                    lists.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found))))
                yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(linked, pa.bool_()), *[pa.array(x, pa.int64()) for x in (sizes, needs, enough)], *lists, *[pa.array(x) for x in np.stack(bits, 1)]], [c.split()[0] for c in COMPARED.split(", ")])

    first = pairs.join(texts.select(F.col("rep").alias("a"), F.col("text").alias("ta")), "a")
    both = first.join(texts.select(F.col("rep").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")
    return both.mapInArrow(run, COMPARED)


def _hubs(cells: DataFrame, sizes: DataFrame, similarity: int) -> DataFrame:
    """(a, b): each member of a family with a hub of its size, the member with most company in its cells.

    A family has a hub for each class of sizes, and a member belongs to two, so linked texts share one.
    """
    shared = cells.groupBy("cell").agg(F.min("rep").alias("first"), F.count("*").alias("n")).filter("n > 1")
    members = saved(cells.join(shared, "cell").select("rep", "first", "n"), "members")
    families = components(members.filter("rep <> first").select(F.col("rep").alias("u"), F.col("first").alias("v")).distinct())
    company = members.groupBy("rep").agg(F.sum("n").alias("n"))
    step = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(101 / similarity))).cast("int")
    # saved before they meet, so that a large family is a join's skewed key that Spark can split
    placed = saved(families.join(company, families["node"] == company["rep"]).join(sizes, "rep").select("rep", "component", "n", F.explode(F.array(step, step + 1)).alias("class")), "placed")
    hubs = placed.groupBy("component", "class").agg(F.max(F.struct("n", (-F.col("rep")).alias("r"))).alias("h")).select("component", "class", (-F.col("h.r")).alias("b"))
    return saved(placed.join(saved(hubs, "hub-of-class"), ["component", "class"]).filter("rep <> b").select(F.col("rep").alias("a"), "b").distinct(), "hubs")


def _offers(seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What members offer, and what unlinked ones hold: b, n and mark of an element, the member, size, all and sketch."""
    sides = F.concat(F.transform("added", lambda e: F.struct(e.alias("e"), F.lit(True).alias("own"))), F.transform("missing", lambda e: F.struct(e.alias("e"), F.lit(False).alias("own"))))
    counts = (F.size("added").alias("added"), (F.size("added") + F.size("missing")).alias("all"))
    apart = seen.select("a", "b", "linked", "size", "need", "enough", *counts, F.inline(sides))
    # elements with the same holders, such as those of one edit, are one mark: the number and the xor of the holders
    held = apart.filter("NOT linked").groupBy("b", "e").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a")).alias("mark"))
    shared = saved(apart.join(held, ["b", "e"]).withColumn("met", F.col("n") - (~F.col("linked")).cast("int")), "shared")
    # what no other holds is offered first and for nothing
    each, kind = Window.partitionBy("a", "b"), Window.partitionBy("a", "b", "own")
    rank = lambda w: F.row_number().over(w.orderBy("met", "mark", "e"))
    ranked = shared.filter("met > 0").withColumn("one", rank(each) <= F.col("need") - (F.col("all") - F.count("*").over(each)))
    ranked = ranked.withColumn("two", F.col("own") & (F.col("enough") <= F.col("added")) & (rank(kind) <= F.col("enough") - (F.col("added") - F.count("*").over(kind))))
    load = lambda c: F.sum(F.when(F.col(c), F.col("met")).otherwise(0)).over(each)
    chosen = F.when((F.col("enough") <= F.col("added")) & (load("two") < load("one")), F.col("two")).otherwise(F.col("one"))
    about = seen.select("a", "b", "linked", "size", (F.size("added") + F.size("missing")).alias("all"), *SKETCH)
    offered = ranked.withColumn("chosen", chosen).filter("chosen").select("b", "n", "mark", "a").distinct()
    holding = shared.filter("NOT linked").select("b", "n", "mark", "a").distinct()
    return offered.join(about, ["a", "b"]), holding.join(about, ["a", "b"])


def near_links(reps: DataFrame, docs: DataFrame, k: int, similarity: int) -> DataFrame:
    """Links (u, v) between classes. reps: rep, size, bands, doc_id and t, which name a row of docs; docs: doc_id, t, text."""
    bands = saved(reps.select("rep", "size", F.explode("bands").alias("band")), "bands")
    shared = bands.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1").select("band")
    # sizes of linked texts differ by three classes at most, and a text is in four cells of a band, so linked
    # texts meet in one, while texts that differ by more than a third in size don't
    step = F.floor(3 * F.log(F.col("size").cast("double")) / F.log(F.lit(101 / similarity))).cast("int")
    cells = saved(bands.join(shared, "band", "left_semi").select("rep", F.explode(F.sequence(step, step + 3)).alias("step"), "band").select("rep", F.xxhash64("band", "step").alias("cell")), "cells")
    forget(bands)
    pairs = _hubs(cells, reps.select("rep", "size"), similarity)
    members = pairs.select(F.col("a").alias("rep")).unionAll(pairs.select("b")).distinct()
    needed = saved(reps.select("rep", "doc_id", "t").join(members, "rep"), "family-members")
    # ids first: they are few bytes, so that most texts need not move; equal rows give a class one text
    near = docs.join(needed.select("doc_id").distinct(), "doc_id", "left_semi")
    texts = saved(near.join(needed, ["doc_id", "t"]).groupBy("doc_id", "t", "rep").agg(F.first("text").alias("text")).select("rep", "text"), "family-texts")
    seen = saved(compared(pairs, texts, k, similarity), "compared")
    offered, holding = _offers(seen)
    x = offered.select("b", "n", "mark", *[F.col(c).alias(f"x_{c}") for c in ("a", "linked", "size", "all", *SKETCH)])
    y = holding.select("b", "n", "mark", *[F.col(c).alias(f"y_{c}") for c in ("a", "size", "all", *SKETCH)])
    bits = lambda of: reduce(add, [F.bit_count(of(c)) for c in SKETCH])
    alike = bits(lambda c: F.col(f"x_{c}").bitwiseAND(F.col(f"y_{c}"))) + F.least(*[F.col(f"{z}_all") - bits(lambda c, z=z: F.col(f"{z}_{c}")) for z in "xy"])
    enough = 2 * (100 + similarity) * alike >= (100 + similarity) * (F.col("x_all") + F.col("y_all")) - (100 - similarity) * (F.col("x_size") + F.col("y_size"))
    # of two unlinked members one offer is enough
    like = (F.col("x_a") != F.col("y_a")) & (F.col("x_linked") | (F.col("x_a") < F.col("y_a"))) & (100 * F.least("x_size", "y_size") >= similarity * F.greatest("x_size", "y_size")) & enough
    more = saved(x.join(y, ["b", "n", "mark"]).filter(like).select(F.greatest("x_a", "y_a").alias("a"), F.least("x_a", "y_a").alias("b")).distinct(), "pairs")
    links = seen.filter("linked").select("a", "b").unionAll(compared(more, texts, k, similarity).filter("linked").select("a", "b"))
    return links.select(F.col("a").alias("u"), F.col("b").alias("v"))


def near_dups(docs: DataFrame, k: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row of docs (doc_id, text)."""
    small_batches(docs.sparkSession)
    own = saved(signatures(docs, k), "signatures")
    filled = own.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    first = filled.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "t")).alias("p"), F.first("n_shingles").alias("size"), F.first("bands").alias("bands"))
    # numbers of classes are drawn once and saved: a doc_id with several texts is in several classes
    classes = saved(first.select("k1", "k2", "p.doc_id", "p.t", "size", "bands").withColumn("rep", F.monotonically_increasing_id()), "classes")
    rows = saved(own.select("doc_id", "n_shingles", "k1", "k2").join(classes.select("k1", "k2", "rep"), ["k1", "k2"], "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles").isNotNull() & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("rep")).alias("rep")), "rows")
    links = near_links(classes.select("rep", "doc_id", "t", "size", "bands"), docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("t"), "text").filter("doc_id IS NOT NULL"), k, similarity)
    # the classes of one doc_id are one node
    several = rows.filter("rep IS NOT NULL").groupBy("doc_id").agg(F.min("rep").alias("v"), F.max("rep").alias("last")).filter("v < last").select("doc_id", "v")
    same = rows.join(saved(several, "several"), "doc_id").filter("rep > v").select(F.col("rep").alias("u"), "v").distinct()
    named = saved(components(links.unionAll(same)), "components")
    joined = classes.select("rep", "doc_id").join(named.withColumnRenamed("node", "rep"), "rep")
    least = saved(joined.groupBy("component").agg(F.min("doc_id").alias("least")), "least")
    reached = saved(joined.join(least, "component").select("rep", "least"), "reached")
    alone = classes.select("rep", F.col("doc_id").alias("own"))
    found = saved(rows.join(alone.join(reached, "rep", "left"), "rep", "left").select("doc_id", "n_shingles", F.coalesce("least", "own", "doc_id").alias("least")), "found")
    # rows without words share the component of the other rows of their doc_id
    mixed = saved(found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("least").alias("c"), F.max("least").alias("most")).filter("c < most").select("doc_id", "c"), "mixed")
    return found.join(mixed, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("c", "least").alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups(table(spark, sf_dir, "documents"), k=4, similarity=80)


def _sql(k: int = 4, similarity: int = 80) -> str:
    """All pairs that share a shingle, and what is reached from each document: for small tables."""
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (SELECT doc_id, hash(unnest(list_distinct(CASE WHEN len(ws) >= {k} THEN list_transform(range(1, len(ws) - {k} + 2), lambda i: array_to_string(ws[i : i + {k - 1}], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END))) AS x FROM w),
sizes AS (SELECT doc_id, count(*)::BIGINT AS n FROM s GROUP BY doc_id),
met AS MATERIALIZED (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT u, v FROM met JOIN sizes p ON p.doc_id = u JOIN sizes q ON q.doc_id = v WHERE 100 * met.n >= {similarity} * (p.n + q.n - met.n)),
reach AS (SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c AS component_id, d.doc_id = c AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT u AS doc_id, min(v) AS c FROM reach GROUP BY u) USING (doc_id)"""


SQL = {"op7_minhash": _sql()}
