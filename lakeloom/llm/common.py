"""Shared pieces: reading inputs, and tables in the folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the text contracts: space, \t, \n, \v, \f and \r.
SPACE = "\\x20\\x09-\\x0D"
WORD = f"[^{SPACE}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_fold(column: str, folds: int) -> Column:
    """crc32 of the value as text, modulo ``folds``; NULL counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % folds


#: DuckDB SQL: crc_table, one row with the table of the crc32 polynomial.
CRC_SQL = """crc_steps(i, n, c) AS (SELECT i, 0, i FROM range(256) r(i) UNION ALL SELECT i, n + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END FROM crc_steps WHERE n < 8),
crc_table AS (SELECT list(c ORDER BY i) AS crcs FROM crc_steps WHERE n = 8)"""


def crc_sql(column: str) -> str:
    """DuckDB SQL: crc32 of the value as text, with crc_table joined."""
    letters = f"list_transform(string_split({column}::VARCHAR, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {letters}), lambda a, b: xor(a >> 8, crcs[(xor(a, b) & 255) + 1])), 4294967295::BIGINT)"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is. Pure ASCII texts take the fast built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def aside(df: DataFrame, prefix: str) -> tuple[DataFrame, dict[str, str]]:
    """df with the columns whose names start as an operator's working columns do under other names, and how to name them back."""
    moved: dict[str, str] = {}
    for c in [c for c in df.columns if c.lower().startswith(prefix)]:
        moved[c] = free_name(df, f"kept{c}")
        df = df.withColumnRenamed(c, moved[c])
    return df, {v: k for k, v in moved.items()}


def scratch(spark: SparkSession) -> str:
    """A folder that the driver and all executors share: the session's checkpoint folder.

    A machine-local folder is set only where none is set and Spark runs in this one process.
    """
    sc = spark.sparkContext
    found = sc.getCheckpointDir()
    if found is None:
        if base := spark.conf.get("spark.checkpoint.dir", None):
            sc.setCheckpointDir(base)
        elif sc.master.startswith("local[") or sc.master == "local":
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="lakeloom-"))
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = sc.getCheckpointDir()
    return found


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """The rows written to a new table in the shared folder and read again: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.saved_at = path
    return out


def forget(df: DataFrame) -> None:
    """Delete a table that ``saved`` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.saved_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bucketed(df: DataFrame, name: str, buckets: int, keys: list[str]) -> DataFrame:
    """The rows as a table in the shared folder, bucketed and sorted by ``keys``: joins of such tables by them need no shuffle.

    Rows that are dealt by the keys to so many partitions already give one file a bucket. The session knows the table by a name of its own.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table_name = f"lakeloom_{path.rsplit('-', 1)[1]}"
    df.write.format("parquet").option("path", path).option("compression", "zstd").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table_name)
    out = spark.table(table_name)
    out.saved_at, out.saved_as = path, table_name
    return out


def forget_table(df: DataFrame) -> None:
    """Delete a table that ``bucketed`` wrote."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {df.saved_as}")
    forget(df)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs whose results are saved.

    It deletes them once the driver's garbage collector finds their plans gone, which a driver with little
    garbage puts off for up to ``spark.cleaner.periodicGC.interval``; the end of a phase with large shuffles asks for it.
    The session's threads hold the last job they ran, so a job of one row goes first.
    """
    spark.range(1).collect()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_batches(spark: SparkSession, most: int = 16 << 20) -> None:
    """Arrow batches of the session at most so large: a task holds a batch several times, in the JVM and in Python."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, "67108864b").lower().rstrip("b")
    if not now.isdigit() or int(now) <= 0 or int(now) > most:
        spark.conf.set(key, str(most))


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
