"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedloom.session import fresh_dir

#: Hash buckets per group in :func:`ranked`; a third of 10^10 rows leaves 800,000 rows a bucket.
BUCKETS = 4096
#: White space that separates words: space and the controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let the session hand texts to Python workers in batches of some megabytes, not 10,000 texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def tasks_for(spark: SparkSession, factor: int = 1) -> int:
    """Partitions for work that is heavy per row: the session's shuffle width."""
    return factor * int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str], facts: DataFrame | None = None, weight: str | None = None) -> DataFrame:
    """Add ``rank``, gapless from 0 within the non-null ``keys``, for groups of any size.

    The order is by a hash of ``order``, then ``order``. Rows are counted per (keys, bucket), counts
    are summed along the buckets of a key, and only rows of one bucket meet in one task. ``facts``
    has one row per key, whose columns come along. Rows equal in ``order`` share a bucket. A row of
    ``weight`` n stands for n rows, and its rank is that of the first.
    """
    count = F.sum(weight) if weight else F.count("*")
    rows = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(BUCKETS)).cast("int"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*keys, "_bucket").agg(count.alias("_n"))
    starts = counts.select(*keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    if facts is not None:
        starts = starts.join(facts, list(keys))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(F.xxhash64(*order), *order)
    joined = rows.join(starts, [*keys, "_bucket"])
    number = F.row_number().over(inside) - 1
    if weight:
        number = F.sum(weight).over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col(weight)
    return joined.withColumn("rank", F.col("_start") + number).drop("_bucket", "_start")


def utf8_bytes(text: Column) -> Column:
    """Length in bytes; null counts as empty."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
