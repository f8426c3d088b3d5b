"""Bronze tables: date-partitioned Parquet below ``base/agency=/feed_type=/date_str_jst=``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.sources.schemas import BRONZE
from feedloom.sources.versions import KEEP_DAYS, VersionLog, read_folders

PARTITION_COLUMNS = ("agency", "feed_type", "date_str_jst")


def write_bronze(rows: DataFrame, base: str, feed_type: str) -> None:
    """Replace exactly the (agency, feed type, date) partitions present in ``rows``.

    The rebalance puts rows of one partition together without making files too small, and
    splits a partition that outgrows ``spark.sql.adaptive.advisoryPartitionSizeInBytes``
    over several tasks and files. Rows without agency or date have no partition and are left out.
    """
    (
        rows.where("agency is not null and date_str_jst is not null")
        .withColumn("feed_type", F.lit(feed_type))
        .hint("rebalance", *PARTITION_COLUMNS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*PARTITION_COLUMNS)
        .parquet(base)
    )


def _write_folder(rows: DataFrame, path: str) -> None:
    rows.hint("rebalance", *PARTITION_COLUMNS).write.option("compression", "zstd").partitionBy(*PARTITION_COLUMNS).parquet(path)


def append_bronze_batch(rows: DataFrame, base: str, feed_type: str, batch_id: int) -> None:
    """Add one streaming batch to the live table at ``base``; the same batch again replaces its rows.

    The batch has a folder of its own and counts once the log names it (``VersionLog``): a late file
    adds to its date without rewriting rows, and readers never see half a batch.
    """
    dated = rows.where("agency is not null and date_str_jst is not null").withColumn("feed_type", F.lit(feed_type))
    VersionLog(rows.sparkSession, base, feed_type).put_batch(batch_id, lambda path: _write_folder(dated, path))


def merge_bronze(spark: SparkSession, live: str, feed_type: str, fan: int = 10, keep_days: float = KEEP_DAYS) -> list[str]:
    """Bound the folders of a live table: merge levels of ``fan`` batches, then remove what is superseded
    for ``keep_days``. May run beside the stream. Returns the removed folders."""
    log, schema = VersionLog(spark, live, feed_type), f"{BRONZE[feed_type]}, feed_type STRING"
    log.merge(lambda folders, path: _write_folder(read_folders(spark, folders, schema), path), fan)
    return log.vacuum(keep_days)


def compact_bronze(spark: SparkSession, live: str, closed: str, feed_type: str, before: str, since_batch: int = -1) -> None:
    """Rewrite streamed dates below ``before`` (YYYYMMDD) as few files in the batch layout.

    Only (agency, date) partitions that got a batch later than ``since_batch`` are written, each
    whole and once, so a late file leads to its date alone being written again. Repeatable.
    """
    log, schema = VersionLog(spark, live, feed_type), f"{BRONZE[feed_type]}, feed_type STRING"
    entries = log.current().entries
    later = read_folders(spark, [f"{live}/{e.folder}" for e in entries if e.last > since_batch], schema)
    touched = later.where(F.col("date_str_jst") < before).select("agency", "date_str_jst").distinct()
    rows = read_folders(spark, [f"{live}/{e.folder}" for e in entries], schema).where(F.col("date_str_jst") < before)
    write_bronze(rows.join(touched, ["agency", "date_str_jst"], "left_semi").drop("feed_type"), closed, feed_type)


def read_bronze(spark: SparkSession, base: str, feed_type: str) -> DataFrame:
    """Rows of one feed type in bronze column order; filters on agency and date prune folders.

    The schema is stated, so a date never comes back as a number and an empty table keeps
    its columns. Of a streamed table the folders of its last version are read.
    """
    schema, log = f"{BRONZE[feed_type]}, feed_type STRING", VersionLog(spark, base, feed_type)
    rows = read_folders(spark, log.folders(), schema) if log.exists() else spark.read.schema(schema).parquet(base)
    table = rows.where(F.col("feed_type") == feed_type)
    names = [field.split()[0] for field in BRONZE[feed_type].replace("\n", " ").split(",")]
    return table.select(*names)


def write_combined(rows: DataFrame, path: str) -> None:
    """All days of a selection as one dataset."""
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)


def read_table(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files, folders or globs as one table."""
    return spark.read.parquet(*paths)


def union_snapshots(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of frames of one schema, duplicates kept; a different schema is an error."""
    result = first
    for other in others:
        result = result.unionByName(other)
    return result


def retention_window(rows: DataFrame, days: int, today: str) -> DataFrame:
    """Rows of the last ``days`` service dates up to ``today`` (YYYYMMDD); prunes date partitions."""
    from datetime import datetime, timedelta

    cutoff = (datetime.strptime(today, "%Y%m%d") - timedelta(days=days)).strftime("%Y%m%d")
    return rows.where(F.col("date_str_jst") >= cutoff)
