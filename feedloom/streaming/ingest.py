"""Continuous ingestion: snapshot files as they land, into bronze."""

from __future__ import annotations

from collections.abc import Callable
from hashlib import md5

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from feedloom.operators.filters import feed_types
from feedloom.operators.flatten import flatten
from feedloom.sources.bronze import append_bronze_batch, merge_bronze
from feedloom.sources.landing import stream_dated_files
from feedloom.sources.snapshots import documents_from_names, quarantine, stream_snapshot_files

# Fixed value: seconds between polls of the realtime feeds.
DEFAULT_INTERVAL = 20
#: Batches between merges of the live table.
MERGE_EVERY = 10


def _writer(feed_type: str, base: str, quarantine_dir: str | None, also: Callable[[int], None] | None):
    def write_batch(files: DataFrame, batch_id: int) -> None:
        docs = documents_from_names(files)
        if quarantine_dir is not None:
            docs = docs.persist(StorageLevel.DISK_ONLY)  # parsed once for rows and quarantine
        append_bronze_batch(flatten(docs, feed_type), base, feed_type, batch_id)
        if quarantine_dir is not None:
            target = f"{quarantine_dir}/feed_type={feed_type}/batch_id={batch_id}"
            quarantine(docs).drop("feed_type").write.mode("overwrite").parquet(target)
            docs.unpersist()
        if batch_id % MERGE_EVERY == MERGE_EVERY - 1:
            merge_bronze(files.sparkSession, base, feed_type)
        if also is not None:
            also(batch_id)

    return write_batch


def stream_bronze(
    spark: SparkSession,
    landing: str,
    base: str,
    checkpoint: str,
    selection: str = "both",
    interval: int = DEFAULT_INTERVAL,
    once: bool = False,
    files_per_batch: int = 10000,
    quarantine_dir: str | None = None,
    archive_dir: str | None = None,
    also: Callable[[int], None] | None = None,
    dated: bool = False,
    **landing_options,
) -> list[StreamingQuery]:
    """Start one query per feed type from ``landing`` to bronze; ``once`` drains and stops.

    Batches start every ``interval`` seconds, or at once when one took longer. A batch that is
    repeated after a failure replaces its own output, so every file counts exactly once. Every
    ``MERGE_EVERY`` batches the folders of the live table are merged and superseded ones removed.
    With ``dated`` the landing folder has a folder per date and only open dates are listed
    (``stream_dated_files``, which takes ``landing_options``).
    ``also`` runs once per batch of the first feed type, which alone owns it, after its rows.
    """
    queries = []
    for owner, feed_type in enumerate(feed_types(selection)):
        if dated:
            files = stream_dated_files(spark, landing, feed_type, files_per_batch, **landing_options)
        else:
            files = stream_snapshot_files(spark, landing, feed_type, files_per_batch, archive_dir, **landing_options)
        writer = (
            files.writeStream.queryName(f"bronze_{feed_type}_{md5(checkpoint.encode()).hexdigest()[:12]}")
            .option("checkpointLocation", f"{checkpoint}/{feed_type}")
            .foreachBatch(_writer(feed_type, base, quarantine_dir, also if owner == 0 else None))
        )
        writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{interval} seconds")
        queries.append(writer.start())
    return queries


def ingest_once(spark: SparkSession, landing: str, base: str, checkpoint: str, selection: str = "both", **options) -> None:
    """Take in everything that has landed, then return."""
    waiting = feed_types(selection)
    while waiting:
        more = []
        for feed_type in waiting:
            (query,) = stream_bronze(spark, landing, base, checkpoint, feed_type, once=True, **options)
            query.awaitTermination()
            # A run over dated folders takes one batch; it is repeated until one finds nothing.
            if options.get("dated") and sum(p["numInputRows"] for p in query.recentProgress):
                more.append(feed_type)
        waiting = more


def stream_with_static(
    spark: SparkSession,
    landing: str,
    base: str,
    checkpoint: str,
    refresh_static: Callable[[], None],
    every_cycle: bool = True,
    selection: str = "both",
    **options,
) -> list[StreamingQuery]:
    """Realtime ingestion with the schedule tables taken in first, and again with each cycle.

    ``refresh_static`` reads the bundles, if they have changed, and writes a version of their tables;
    it must be repeatable.
    One query owns it, so two refreshes never run at the same time.
    """
    refresh_static()
    also = (lambda batch_id: refresh_static() if batch_id > 0 else None) if every_cycle else None
    return stream_bronze(spark, landing, base, checkpoint, selection, also=also, **options)
