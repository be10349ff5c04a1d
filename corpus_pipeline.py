"""A corpus pipeline of five stages over documents; each stage's rows are written and read again.

NULL and empty texts are no one's copies, hold no lines to lose, no toxic words and no benchmark items, so they
stay until the mix, which takes them as often as other rows of their source; rows that repeat a doc_id are
one document to the stages that compare documents; an empty table goes through as such; further columns of
documents pass all stages, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import decontam, line_dedup, minhash, mixing, toxicity
from lakeloom.llm.common import aside, free_name, saved, table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    name = free_name(docs, "_tox")
    return toxicity.score_texts(docs, model, name).filter(F.col(name) < toxicity.THRESHOLD).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the repeated lines that another one keeps; n_chars follows the text."""
    shielded, back = aside(docs, "_ld")
    kept = line_dedup.dedup_lines(shielded)
    length = F.char_length("text").cast("long")
    cut = kept.withColumn("n_chars", F.when(F.col("_ld_dropped") > 0, length).otherwise(F.col("n_chars")))
    return cut.select(*shielded.columns).withColumnsRenamed(back)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id."""
    found = minhash.near_dups(docs)
    gone = found.filter("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as their source's rate says."""
    return mixing.mix(docs)


STAGES = [("toxicity", toxic), ("line dedup", lines), ("near-dedup", near), ("decontamination", leaks), ("mixing", mixed)]

#: None: neither the scores nor the edit matching can be put into SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
