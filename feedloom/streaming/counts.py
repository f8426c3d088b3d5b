"""Counts per minute while rows arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedloom.operators.activity import minute_counts
from feedloom.sources.versions import KEEP_DAYS, VersionLog, read_folders

_NAME = "minutes"


def _schema(by: str) -> str:
    return f"{by} STRING, minute TIMESTAMP_NTZ, n BIGINT"


def stream_minute_counts(
    stream: DataFrame, path: str, checkpoint: str, ts: str = "snapshot_ts_jst", by: str = "agency", once: bool = False, interval: int = 20
) -> StreamingQuery:
    """Count rows per (by, minute) into the table at ``path``.

    Each batch adds its own counts in a folder of its own and replaces them if it is repeated. Sums
    over batches are exact at any time, for late rows and open minutes too, and no state is held.
    """

    def write_batch(rows: DataFrame, batch_id: int) -> None:
        counts = minute_counts(rows, ts, [by])
        VersionLog(rows.sparkSession, path, _NAME).put_batch(batch_id, lambda folder: counts.write.parquet(folder))

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write_batch)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{interval} seconds")).start()


def _summed(counts: DataFrame, by: str) -> DataFrame:
    return counts.groupBy(by, "minute").agg(F.sum("n").alias("n"))


def read_minute_counts(spark: SparkSession, path: str, by: str = "agency") -> DataFrame:
    """(by, minute, n) of everything counted so far."""
    return _summed(read_folders(spark, VersionLog(spark, path, _NAME).folders(), _schema(by)), by)


def merge_minute_counts(spark: SparkSession, path: str, by: str = "agency", fan: int = 10, keep_days: float = KEEP_DAYS) -> list[str]:
    """Add up the counts of ``fan`` folders into one, beside the running stream; removes superseded ones."""
    log = VersionLog(spark, path, _NAME)
    log.merge(lambda folders, target: _summed(read_folders(spark, folders, _schema(by)), by).write.parquet(target), fan)
    return log.vacuum(keep_days)


def compact_minute_counts(spark: SparkSession, path: str, target: str, by: str = "agency") -> None:
    """The counts so far as one table of the same layout, to go on from once the stream is moved there."""
    counts = read_minute_counts(spark, path, by)
    VersionLog(spark, target, _NAME).put_batch(-1, lambda folder: counts.write.parquet(folder))
