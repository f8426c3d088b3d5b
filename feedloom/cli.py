"""Command line: ``python -m feedloom.cli <command>``; submit with spark-submit on a cluster."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from feedloom.plans import normalise
from feedloom.sources.bronze import compact_bronze, merge_bronze
from feedloom.sources.versions import KEEP_DAYS
from feedloom.streaming.ingest import DEFAULT_INTERVAL, ingest_once, stream_bronze, stream_with_static


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="feedloom")
    commands = parser.add_subparsers(dest="command", required=True)

    folder = commands.add_parser("normalise", help="snapshot folder to bronze")
    archives = commands.add_parser("archives", help="tar archives to bronze")
    for command in (folder, archives):
        command.add_argument("--input-dir", required=True)
        command.add_argument("--output-dir")
        command.add_argument("--feed-type", default="both", choices=["trip_updates", "vehicle_positions", "both"])
        command.add_argument("--agency-filter")
        command.add_argument("--quarantine-dir")
    archives.add_argument("--pattern", default="*.tar*")
    archives.add_argument("--show-agencies", action="store_true")

    payloads = commands.add_parser("payloads", help="raw protobuf payloads to bronze")
    payloads.add_argument("--input-dir", required=True)
    payloads.add_argument("--output-dir", required=True)
    payloads.add_argument("--feed-type", default="both", choices=["trip_updates", "vehicle_positions", "both"])

    compact = commands.add_parser("compact", help="merge folders of a live table, or rewrite its closed dates")
    compact.add_argument("--live-dir", required=True)
    compact.add_argument("--feed-type", required=True, choices=["trip_updates", "vehicle_positions"])
    compact.add_argument("--keep-days", type=float, default=KEEP_DAYS, help="for superseded folders")
    compact.add_argument("--closed-dir", help="batch table for dates before --before")
    compact.add_argument("--before", help="YYYYMMDD")
    compact.add_argument("--since-batch", type=int, default=-1)

    ingest = commands.add_parser("ingest", help="landing folder to bronze, continuously or once")
    ingest.add_argument("--landing", required=True)
    ingest.add_argument("--output-dir", required=True)
    ingest.add_argument("--checkpoint", required=True)
    ingest.add_argument("--feed-type", default="realtime", choices=["trip_updates", "vehicle_positions", "realtime", "gtfs_static", "all"])
    ingest.add_argument("--bundles", help="schedule bundles, for gtfs_static and all")
    ingest.add_argument("--schedule-dir", help="where schedule tables go, for gtfs_static and all")
    ingest.add_argument("--interval", type=int, default=DEFAULT_INTERVAL)
    ingest.add_argument("--once", action="store_true")
    ingest.add_argument("--quarantine-dir")
    ingest.add_argument("--archive-dir", help="where files move once they are taken in")
    ingest.add_argument("--dated", action="store_true", help="the landing folder has a folder per date, YYYYMMDD")

    headway = commands.add_parser("headway", help="headway statistics of a stop_times file")
    headway.add_argument("--stop-times", required=True)
    headway.add_argument("--output-dir", required=True)
    return parser


def main(argv: list[str] | None = None) -> None:
    parser = _parser()
    args = parser.parse_args(argv)
    if getattr(args, "feed_type", "") in ("gtfs_static", "all") and not (args.bundles and args.schedule_dir):
        parser.error(f"--feed-type {args.feed_type} needs --bundles and --schedule-dir")
    if args.command == "compact" and bool(args.closed_dir) != bool(args.before):
        parser.error("--closed-dir and --before go together")
    spark = SparkSession.builder.appName(f"feedloom-{args.command}").getOrCreate()
    if args.command == "normalise":
        normalise.normalise_folder(
            spark, args.input_dir, args.output_dir, args.feed_type, args.agency_filter, args.quarantine_dir
        )
    elif args.command == "archives" and args.show_agencies:
        report = normalise.archive_agencies(spark, args.input_dir, args.pattern, args.agency_filter)
        if args.output_dir:
            report.write.mode("overwrite").parquet(args.output_dir)
        else:
            for row in report.orderBy("agency").toLocalIterator():
                print(*row, sep="\t")
    elif args.command == "archives":
        normalise.normalise_archives(
            spark, args.input_dir, args.output_dir, args.pattern, args.agency_filter, args.feed_type, args.quarantine_dir
        )
    elif args.command == "payloads":
        normalise.payloads_to_bronze(spark, args.input_dir, args.output_dir, args.feed_type)
    elif args.command == "compact" and args.closed_dir:
        compact_bronze(spark, args.live_dir, args.closed_dir, args.feed_type, args.before, args.since_batch)
    elif args.command == "compact":
        merge_bronze(spark, args.live_dir, args.feed_type, keep_days=args.keep_days)
    elif args.command == "ingest":
        options = {"quarantine_dir": args.quarantine_dir, "archive_dir": args.archive_dir, "interval": args.interval, "once": args.once, "dated": args.dated}
        place = (spark, args.landing, args.output_dir, args.checkpoint)
        refresh = lambda: normalise.refresh_static_tables(spark, args.bundles, args.schedule_dir)
        if args.feed_type == "gtfs_static":
            return refresh()
        if args.feed_type == "all":
            queries = stream_with_static(*place, refresh, selection="realtime", **options)
        elif args.once and args.dated:
            options.pop("once")
            return ingest_once(*place, args.feed_type, **options)
        else:
            queries = stream_bronze(*place, args.feed_type, **options)
        if args.once:
            for query in queries:
                query.awaitTermination()
        else:
            # The first query to fail ends the application; a restart resumes from the checkpoint.
            spark.streams.awaitAnyTermination()
    else:
        stats, by_route = normalise.headway_report(spark, args.stop_times)
        stats.write.mode("overwrite").parquet(f"{args.output_dir}/by_route_and_stop")
        by_route.write.mode("overwrite").parquet(f"{args.output_dir}/by_route")


if __name__ == "__main__":
    main()
