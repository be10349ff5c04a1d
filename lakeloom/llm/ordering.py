"""A global row number and running sums without one task that holds all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, shuffle_parts


def running(df: DataFrame, order: list[Column], sums: dict[str, str], rank: str = "rank") -> DataFrame:
    """Adds ``rank`` (0-based) and, for each {name: column}, the sum over all earlier rows in ``order``.

    Rows are range-partitioned; each part ranks its own rows, and the parts' totals, at most
    one row for each shuffle partition, give the offsets. ``order`` must not tie.
    """
    spark = df.sparkSession
    parts = saved(df.repartitionByRange(shuffle_parts(spark), *order).withColumn("_part", F.spark_partition_id()), "ranges")
    totals = parts.groupBy("_part").agg(F.count("*").alias("_n"), *[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    offsets = totals.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n"), *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_t_{n}") for n in sums])
    own = Window.partitionBy("_part").orderBy(*order)
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    local = parts.select("*", (F.row_number().over(own) - 1).alias("_r"), *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_s_{n}") for n, c in sums.items()])
    out = local.join(F.broadcast(offsets), "_part")
    return out.select(*df.columns, (F.col("_r") + F.col("_n")).alias(rank), *[(F.col(f"_s_{n}") + F.col(f"_t_{n}")).alias(n) for n in sums])
