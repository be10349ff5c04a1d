"""Line dedup over levelled sorted runs of line hashes.

A run is a bucketed table of (h1, h2, n_docs, keeper), sorted by the 128-bit line hash within buckets.
Documents arrive in batches by descending doc_id; the number of batches follows the size of the texts. A batch's
keys are dealt to the runs' buckets once; it merge-anti-joins the settled keys, those known from ``min_docs``
documents, whose keeper cannot change any more, and adds its other keys as a new run of level 0. When a level
has ``fanout`` runs they are compacted: merged bucket by bucket into one run of the next level, and the keys that
are settled now move to the settled runs, which have levels of their own. No batch or compaction shuffles
a run again. At the end the open runs are compacted once more; the settled runs name every key of many documents
with its keeper, and a document loses the lines whose key they hold for another keeper.

Nulls and edge cases: a NULL or empty text is one empty line; a key is the line without
[\\x20\\x09-\\x0D] at both ends and with A-Z lower-cased, and shorter keys than ``min_chars`` code
points stay; rows with one doc_id are one document for the counts, and lose lines alike; a row with
NULL doc_id keeps all lines and counts nowhere; an empty table gives an empty result. Extra columns
pass through ``dedup_lines``; columns named _ld_lines, _ld_dropped are replaced by its own.

Keys are compared by 128 bits of hash, so two different lines meet with probability near n^2/2^129.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, ascii_lower, aside, bucketed, forget, forget_table, saved, shuffle_parts, table

MIN_CHARS, MIN_DOCS, FANOUT = 20, 3, 3
#: Bytes of texts in a batch, and bounds for the number of batches.
BATCH, LEAST_BATCHES, MOST_BATCHES = 64 << 30, 4, 64
_ENDS = " \t\n\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def keys_of(text: Column) -> Column:
    return F.transform(F.split(ascii_lower(F.coalesce(text, F.lit(""))), "\n"), lambda s: F.btrim(s, F.lit(_ENDS)))


def _hash(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2"))


class LineRuns:
    """Levels of runs, lowest first: open ones, and settled ones. Held on the driver as table handles only."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = buckets or shuffle_parts(spark)
        self.open: list[list[DataFrame]] = []
        self.done: list[list[DataFrame]] = []

    def _run(self, rows: DataFrame, name: str) -> DataFrame:
        return bucketed(rows, name, self.buckets, ["h1", "h2"])

    @staticmethod
    def joined(a: DataFrame, b: DataFrame) -> DataFrame:
        """Two runs as one; bucket meets bucket, so neither is shuffled."""
        other = b.select("h1", "h2", F.col("n_docs").alias("_n"), F.col("keeper").alias("_k"))
        n = F.coalesce("n_docs", F.lit(0)) + F.coalesce("_n", F.lit(0))
        return a.join(other, ["h1", "h2"], "full").select("h1", "h2", n.alias("n_docs"), F.greatest("keeper", "_k").alias("keeper"))

    def merged(self, runs: list[DataFrame]) -> tuple[DataFrame, list[DataFrame]]:
        """Runs as one, two at a time (a union would lose the buckets), and the tables made on the way."""
        out, made = runs[0], []
        for i, r in enumerate(runs[1:], 2):
            out = self.joined(out, r)
            if i < len(runs):
                out = self._run(out, "merged-run")
                made.append(out)
        return out, made

    def add(self, pairs: DataFrame) -> None:
        """One batch of (h1, h2, doc_id), of documents with smaller ids than all batches before."""
        own = pairs.groupBy("h1", "h2").agg(F.countDistinct("doc_id").alias("n_docs"), F.max("doc_id").alias("keeper")).repartition(self.buckets, "h1", "h2")
        for level in self.done:
            for run in level:
                own = own.join(run.select("h1", "h2"), ["h1", "h2"], "left_anti")
        self._put(self.open, 0, self._run(own, "line-run-0"))

    def _put(self, levels: list[list[DataFrame]], level: int, run: DataFrame) -> None:
        while len(levels) <= level:
            levels.append([])
        levels[level].append(run)
        if len(levels[level]) < self.fanout:
            return
        runs, levels[level] = levels[level], []
        both, made = self.merged(runs)
        if levels is self.open:
            # keys that are settled now leave the open runs
            many = F.col("n_docs") >= self.min_docs
            self._put(self.done, 0, self._run(both.filter(many), "settled-run"))
            both = both.filter(~many)
        self._put(levels, level + 1, self._run(both, f"line-run-{level + 1}"))
        for r in (*runs, *made):
            forget_table(r)

    def settled(self) -> DataFrame | None:
        """(h1, h2, n_docs, keeper) of all keys of ``min_docs`` documents; asked once, after all batches."""
        runs = [r for level in (*self.open, *self.done) for r in level]
        if not runs:
            return None
        both, made = self.merged(runs)
        self.open.append(made)
        return both.filter(F.col("n_docs") >= self.min_docs)

    def forget(self) -> None:
        for level in (*self.open, *self.done):
            for r in level:
                forget_table(r)


def batches_of(docs: DataFrame) -> int:
    """Batches of about BATCH bytes of texts, within bounds."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return min(MOST_BATCHES, max(LEAST_BATCHES, -(-size // BATCH)))


def build_runs(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int | None = None, fanout: int = FANOUT) -> LineRuns:
    """Runs over all of docs (doc_id, text), in ``batches`` by descending doc_id."""
    spark = docs.sparkSession
    runs = LineRuns(spark, min_docs, fanout)
    known = docs.filter("doc_id IS NOT NULL").select("doc_id", "text")
    batches = batches or batches_of(known)
    cuts = known.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000).alias("q")).first()["q"] if batches > 1 else []
    batch = sum([(F.col("doc_id") <= c).cast("int") for c in cuts or []], F.lit(0))
    keyed = known.select("doc_id", batch.alias("batch"), F.explode(F.array_distinct(F.transform(F.filter(keys_of(F.col("text")), lambda k: F.char_length(k) >= min_chars), _hash))).alias("h"))
    pairs = saved(keyed.select("batch", "doc_id", "h.h1", "h.h2"), "line-keys", ["batch"])
    for b in range(batches):
        runs.add(pairs.filter(F.col("batch") == b).select("doc_id", "h1", "h2"))
    forget(pairs)
    return runs


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int | None = None, fanout: int = FANOUT) -> DataFrame:
    """docs with ``text`` cut down to the kept lines, plus _ld_lines and _ld_dropped (counts)."""
    docs, back = aside(docs, "_ld")
    runs = build_runs(docs, min_chars, min_docs, batches, fanout)
    repeated = saved(runs.settled().select("h1", "h2", "keeper"), "line-keepers")
    runs.forget()
    long_lines = F.filter(F.transform(keys_of(F.col("text")), lambda k, i: F.struct(i.cast("int").alias("at"), k.alias("k"))), lambda x: F.char_length(x["k"]) >= min_chars)
    placed = docs.filter("doc_id IS NOT NULL").select("doc_id", F.xxhash64("text").alias("t"), F.explode(F.transform(long_lines, lambda x: F.struct(x["at"].alias("at"), _hash(x["k"]).alias("h")))).alias("x")).select("doc_id", "t", "x.at", "x.h.h1", "x.h.h2")
    lost = placed.join(repeated, ["h1", "h2"]).filter(F.col("doc_id") != F.col("keeper")).groupBy("doc_id", "t").agg(F.collect_set("at").alias("_ld_lost")).select(F.col("doc_id").alias("_ld_id"), F.col("t").alias("_ld_t"), "_ld_lost")
    joined = docs.join(lost, (docs["doc_id"] == lost["_ld_id"]) & (F.xxhash64(docs["text"]) == lost["_ld_t"]), "left")
    split = lines_of(docs["text"])
    places = F.array_except(F.sequence(F.lit(0), F.size("_ld_all") - 1), F.col("_ld_lost"))
    shorter = F.when(F.col("_ld_lost").isNull(), F.coalesce(docs["text"], F.lit(""))).otherwise(F.array_join(F.transform(places, lambda i: F.element_at(F.col("_ld_all"), i + 1)), "\n"))
    out = joined.withColumn("_ld_all", split).withColumn("_ld_text", shorter)
    lines, dropped = F.size("_ld_all").cast("long"), F.coalesce(F.size("_ld_lost"), F.lit(0)).cast("long")
    made = {c: F.col("_ld_text") if c == "text" else docs[c] for c in docs.columns}
    named = {back.get(c, c): x for c, x in made.items()} | {"_ld_lines": lines, "_ld_dropped": dropped}
    return out.select(*[x.alias(c) for c, x in named.items()])


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", F.col("_ld_lines").alias("n_lines"), F.col("_ld_dropped").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256"))


def line_sql(docs: str) -> str:
    """DuckDB SQL: (rid, doc_id, n_lines, n_dropped, kept) for each row of ``docs``, which has a unique rid."""
    return f"""
ln AS (SELECT rid, doc_id, generate_subscripts(parts, 1) AS i, unnest(parts) AS line FROM (SELECT rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM {docs})),
keyed AS (SELECT *, translate(trim(line, E' \\t\\n\\x0b\\x0c\\r'), '{UPPER}', '{LOWER}') AS k FROM ln),
many AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= {MIN_CHARS} GROUP BY k HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
judged AS (SELECT rid, i, line, coalesce(many.keeper <> doc_id, false) AS gone FROM keyed LEFT JOIN many USING (k)),
lines_kept AS (SELECT rid, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS kept FROM judged GROUP BY rid)"""


SQL = {"op1_line_dedup": f"WITH src AS (SELECT *, row_number() OVER () AS rid FROM documents), {line_sql('src')} SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM lines_kept JOIN src USING (rid)".replace("SELECT doc_id,", "SELECT src.doc_id AS doc_id,")}
