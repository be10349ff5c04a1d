"""Mixing sources to target weights: floor(rate) copies and one hash-seeded Bernoulli copy.

Sizes are summed per source, capped targets follow from the weights by water filling, and the
rate of a source is target / size. A document is emitted floor(rate) times, plus once more with
probability rate - floor(rate), decided by a hash of a seed and its doc_id, so that reruns agree.

Nulls and edge cases: a NULL source is a source of its own, last in order; a NULL or blank text
has size 0 and is emitted like any other row of its source; a source of size 0 has target 0 and
rate 0; rows that repeat a doc_id draw alike; a NULL doc_id draws as the text 'null'; an empty
table gives an empty mix. Extra columns pass through ``mix``, whatever their names.
Only built-in functions are used. The per-source table joins back by an ordinary join, which
Spark may broadcast when its measured size is below the session's threshold and which AQE splits
on a hot source otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, aside, saved, table
from .ordering import running

#: A document is emitted at most this often.
MOST = 3
WEIGHTS = (1, 2, 3)
SEED = "mix-1"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) from 32 bits of md5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long").cast("double") / F.lit(4294967296.0)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(_mix_source, _mix_total, _mix_target) from (_mix_source, _mix_total); sources by code point, NULL last.

    With sources by cap/weight, the level is the first (rest of the total) / (rest of the weights)
    that does not exceed its own source's cap/weight; a target is the smaller of cap and level x weight.
    """
    ranked = running(sizes, [F.col("_mix_source").asc_nulls_last()], {}, "_mix_rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_mix_rank") % len(weights) + 1).cast("int")).cast("long")
    capped = ranked.select("_mix_source", "_mix_total", weight.alias("_mix_w"), (F.col("_mix_total") * most).alias("_mix_cap"))
    ratio = F.col("_mix_cap").cast("double") / F.col("_mix_w")
    filled = running(capped.withColumn("_mix_ratio", ratio), [F.col("_mix_ratio"), F.col("_mix_source").asc_nulls_last()], {"_mix_caps": "_mix_cap", "_mix_ws": "_mix_w"}, "_mix_k")
    whole = sizes.agg(F.coalesce(F.sum("_mix_total"), F.lit(0)).alias("_mix_all"))
    weighed = capped.agg(F.coalesce(F.sum("_mix_w"), F.lit(0)).alias("_mix_allw"))
    level = (F.col("_mix_all") - F.col("_mix_caps")).cast("double") / (F.col("_mix_allw") - F.col("_mix_ws"))
    # both sides of these cross joins are one row of totals
    levelled = filled.crossJoin(F.broadcast(whole)).crossJoin(F.broadcast(weighed)).withColumn("_mix_level", level)
    first = levelled.filter(F.col("_mix_level") <= F.col("_mix_ratio")).agg(F.min_by("_mix_level", "_mix_k").alias("_mix_at"))
    return capped.crossJoin(F.broadcast(first)).select("_mix_source", "_mix_total", F.least(F.col("_mix_cap").cast("double"), F.col("_mix_at") * F.col("_mix_w")).alias("_mix_target"))


def plan_copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, copies of each row of docs (doc_id, text, source)."""
    sized = saved(docs.select("doc_id", F.col("source").alias("_mix_source"), size_of(F.col("text")).alias("size")), "mix-sizes")
    per = saved(targets(saved(sized.groupBy("_mix_source").agg(F.sum("size").alias("_mix_total")), "mix-sources"), weights, most), "mix-targets")
    rate = F.when(F.col("_mix_total") > 0, F.col("_mix_target") / F.col("_mix_total")).otherwise(F.lit(0.0))
    copies = F.least(F.floor(rate) + F.when(draw(F.col("doc_id"), seed) < rate - F.floor(rate), 1).otherwise(0), F.lit(most)).cast("long")
    joined = sized.withColumnRenamed("_mix_source", "_mix_of").join(per, F.col("_mix_of").eqNullSafe(F.col("_mix_source")))
    return joined.select("doc_id", "size", F.col("_mix_total").alias("source_size"), F.col("_mix_target").alias("target"), copies.alias("copies"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The mixed corpus: every row of docs as often as its source's rate says, columns unchanged."""
    docs, back = aside(docs, "_mix")
    sizes = saved(docs.select(F.col("source").alias("_mix_source"), size_of(F.col("text")).alias("size")).groupBy("_mix_source").agg(F.sum("size").alias("_mix_total")), "mix-sources")
    per = saved(targets(sizes, weights, most), "mix-targets")
    rate = F.when(F.col("_mix_total") > 0, F.col("_mix_target") / F.col("_mix_total")).otherwise(F.lit(0.0))
    copies = F.least(F.floor(rate) + F.when(draw(docs["doc_id"], seed) < rate - F.floor(rate), 1).otherwise(0), F.lit(most)).cast("int")
    rated = docs.join(per, docs["source"].eqNullSafe(per["_mix_source"])).withColumn("_mix_copies", copies).filter("_mix_copies > 0")
    return rated.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies")))).select(*[docs[c] for c in docs.columns]).withColumnsRenamed(back)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = plan_copies(table(spark, sf_dir, "documents"))
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix_sql(docs: str) -> str:
    """DuckDB SQL: every row of ``docs`` with size, source_size, target and copies."""
    return f"""
sized AS (SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM {docs}),
per AS (SELECT source AS src, sum(size)::BIGINT AS total FROM sized GROUP BY source),
weighed AS (SELECT *, (1 + (row_number() OVER (ORDER BY src ASC NULLS LAST) - 1) % 3)::BIGINT AS w, total * 3 AS cap FROM per),
filled AS (SELECT *, cap::DOUBLE / w AS ratio,
  coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, src ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caps,
  coalesce(sum(w) OVER (ORDER BY cap::DOUBLE / w, src ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ws FROM weighed),
levels AS (SELECT ((SELECT sum(total) FROM per) - caps)::DOUBLE / ((SELECT sum(w) FROM weighed) - ws)::DOUBLE AS level, ratio, caps, ws FROM filled),
lev AS (SELECT min_by(level, ws) AS v FROM levels WHERE level <= ratio),
goal AS (SELECT src, total, least(cap::DOUBLE, (SELECT v FROM lev) * w) AS target FROM weighed),
rated AS (SELECT s.*, g.total AS source_size, g.target, CASE WHEN g.total > 0 THEN g.target / g.total ELSE 0 END AS rate,
  ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS u
  FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.src),
mixed AS (SELECT *, least(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END, 3)::BIGINT AS copies FROM rated)"""


SQL = {"op4_mixing": f"WITH {mix_sql('documents')} SELECT doc_id, size, source_size, target, size * copies AS taken FROM mixed"}
