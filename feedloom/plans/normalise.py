"""Whole jobs: snapshot folders and archives to bronze, schedules to headways."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.filters import feed_types
from feedloom.operators.flatten import flatten
from feedloom.operators.headway import headway_by_route, headway_stats
from feedloom.operators.reports import document_log, ingest_report
from feedloom.session import fresh_dir
from feedloom.sources.archives import scan_archives
from feedloom.sources.bronze import write_bronze
from feedloom.sources.files import read_payloads
from feedloom.sources.protobuf import decode_trip_updates, decode_vehicle_positions
from feedloom.sources.snapshots import (
    documents_from_members,
    documents_from_names,
    keep_agencies,
    of_named_agencies,
    quarantine,
    read_snapshot_files,
)
from feedloom.sources.versions import KEEP_DAYS, Entry, VersionLog, read_folders
from feedloom.sources.static import good_rows, read_static_bundles, read_stop_times_csv, static_table


def snapshot_rows(spark: SparkSession, landing: str, feed_type: str, agencies: str | None = None, **quirks) -> DataFrame:
    """Bronze rows of every snapshot file of one feed type.

    Files that name another agency are not parsed; documents found to be of another one are
    not exploded.
    """
    files = of_named_agencies(read_snapshot_files(spark, landing, feed_type), agencies)
    return flatten(keep_agencies(documents_from_names(files, **quirks), agencies), feed_type)


def normalise_folder(
    spark: SparkSession,
    landing: str,
    base: str,
    selection: str = "both",
    agencies: str | None = None,
    quarantine_dir: str | None = None,
) -> None:
    """Snapshot files below ``landing`` to bronze, one job per feed type."""
    for feed_type in feed_types(selection):
        if quarantine_dir is None:
            write_bronze(snapshot_rows(spark, landing, feed_type, agencies), base, feed_type)
            continue
        # Parsed once for rows and quarantine.
        docs = documents_from_names(of_named_agencies(read_snapshot_files(spark, landing, feed_type), agencies)).persist(StorageLevel.DISK_ONLY)
        write_bronze(flatten(keep_agencies(docs, agencies), feed_type), base, feed_type)
        quarantine(docs).write.mode("overwrite").parquet(f"{quarantine_dir}/{feed_type}")
        docs.unpersist()


def archive_documents(spark: SparkSession, base: str, pattern: str = "*.tar*", selection: str = "both", **quirks) -> DataFrame:
    """Parsed members of all archives; all archives are read before anything is written."""
    return documents_from_members(scan_archives(spark, base, pattern, selection), **quirks)


def normalise_archives(
    spark: SparkSession,
    archives: str,
    base: str,
    pattern: str = "*.tar*",
    agencies: str | None = None,
    selection: str = "both",
    quarantine_dir: str | None = None,
    **quirks,
) -> None:
    """Archive members to bronze. Rows of one date from several archives end up together.

    Archives are opened once; their members wait in the shared folder and are parsed per feed.
    """
    members = fresh_dir(spark, "members")
    scan_archives(spark, archives, pattern, selection).write.option("compression", "zstd").parquet(members)
    docs = documents_from_members(spark.read.parquet(members), **quirks)
    if quarantine_dir is not None:
        docs = docs.persist(StorageLevel.DISK_ONLY)  # parsed once for all feeds and quarantine
    for feed_type in feed_types(selection):
        write_bronze(flatten(keep_agencies(docs.where(F.col("feed_type") == feed_type), agencies), feed_type), base, feed_type)
    if quarantine_dir is not None:
        quarantine(docs).write.mode("overwrite").parquet(quarantine_dir)
        docs.unpersist()


def archive_agencies(spark: SparkSession, archives: str, pattern: str = "*.tar*", agencies: str | None = None) -> DataFrame:
    """What the archives hold per agency, without writing bronze."""
    return ingest_report(document_log(archive_documents(spark, archives, pattern), agencies))


def bundle_stop_times(spark: SparkSession, bundles: str) -> DataFrame:
    rows = good_rows(read_static_bundles(spark, bundles, tables=["stop_times"]))
    return static_table(rows, "stop_times", ["trip_id", "stop_id", "departure_time"])


def headway_report(spark: SparkSession, stop_times_csv: str) -> tuple[DataFrame, DataFrame]:
    """(per route and stop, per route) of a stop_times file."""
    stats = headway_stats(read_stop_times_csv(spark, stop_times_csv))
    return stats, headway_by_route(stats)


_SCHEDULE = "archive STRING, line_no BIGINT, row MAP<STRING, STRING>, table STRING"


def _bundle_state(spark: SparkSession, bundles: str) -> str:
    """Tells one state of a bundle folder from another: a digest over paths, sizes and times of change."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.zip").load(bundles)
    marks = files.select(F.md5(F.concat_ws(" ", "path", "length", F.unix_micros("modificationTime"))).alias("mark"))
    halves = [F.conv(F.substring("mark", at, 15), 16, 10).cast("decimal(38,0)") for at in (1, 16)]
    return "-".join(str(x) for x in marks.agg(F.count("*"), *[F.sum(h) for h in halves]).first())


def refresh_static_tables(spark: SparkSession, bundles: str, base: str, keep_days: float = KEEP_DAYS) -> bool:
    """Write the schedule rows of all bundles as a new version below ``base``, if the bundles have changed.

    A version has a folder of its own, partitioned by table name, and counts once it is complete, so
    readers see one whole version and a refresh that runs twice gives equal versions. Versions
    superseded for ``keep_days`` are removed. Tells whether there is a new version.
    """
    log, state = VersionLog(spark, base, "schedule"), _bundle_state(spark, bundles)
    if log.exists() and log.current().source == state:
        return False
    folder = log.fresh()
    rows = good_rows(read_static_bundles(spark, bundles))
    rows.hint("rebalance", "table").write.option("compression", "zstd").partitionBy("table").parquet(f"{log.base}/{folder}")
    log.commit(lambda entries: (Entry(folder),), state)
    log.vacuum(keep_days)
    return True


def read_static_tables(spark: SparkSession, base: str) -> DataFrame:
    """The schedule rows of the last complete version."""
    return read_folders(spark, VersionLog(spark, base, "schedule").folders(), _SCHEDULE)


def payload_documents(payloads: DataFrame, feed_type: str) -> DataFrame:
    """Parsed documents of protobuf payloads ``(path, content)`` named as snapshots.

    Each payload becomes the flat document that its snapshot would hold, so it takes the same way to
    bronze; one that can't be decoded has no text and ends in quarantine as ``bad_json``.
    """
    decode = decode_trip_updates if feed_type == "trip_updates" else decode_vehicle_positions
    document = F.struct(F.lit(feed_type).alias("feed_type"), "timestamp", F.col(feed_type))
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.pb$", ".json")
    text = F.when(F.col(feed_type).isNotNull(), F.to_json(document)).otherwise("")
    return documents_from_names(decode(payloads).select(name.alias("snapshot_filename"), text.alias("content")))


def payloads_to_bronze(spark: SparkSession, landing: str, base: str, selection: str = "both", pattern: str = "*.pb") -> None:
    """Raw payload files below ``landing`` to bronze."""
    for feed_type in feed_types(selection):
        payloads = read_payloads(spark, landing, f"gtfs_rt_{feed_type}_{pattern}")
        write_bronze(flatten(payload_documents(payloads, feed_type), feed_type), base, feed_type)


def map_table(vp: DataFrame) -> DataFrame:
    """Map points with the epoch milliseconds and the time as text that a map export carries."""
    from feedloom.functions.clock import epoch_ms, ts_text
    from feedloom.operators.filters import project_map_points

    ts = F.col("snapshot_ts_jst")
    return project_map_points(vp).withColumns({"timestamp": epoch_ms(ts), "snapshot_ts": ts_text(ts)})
