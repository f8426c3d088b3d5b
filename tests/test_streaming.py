"""Streams equal their batch form, count every file once, and add late files to their date."""

import json

from pyspark.sql import functions as F

from feedloom import cli
from feedloom.sources.bronze import read_bronze
from feedloom.plans import normalise
from feedloom.streaming.counts import compact_minute_counts, read_minute_counts, stream_minute_counts
from feedloom.streaming.ingest import ingest_once, stream_bronze, stream_with_static


def land(folder, feed, agency, stamp, *trips):
    folder.mkdir(parents=True, exist_ok=True)
    items = [{"trip_id": t, "vehicle_id": "v"} for t in trips]
    (folder / f"gtfs_rt_{feed}_{agency}_{stamp}.json").write_text(json.dumps({feed: items}, indent=2))


def trips(spark, base, feed="trip_updates"):
    return sorted((r.agency, r.date_str_jst, r.trip_id) for r in read_bronze(spark, base, feed).collect())


def test_ingest_in_rounds(spark, tmp_path):
    landing, base, offsets = tmp_path / "landing", str(tmp_path / "bronze"), str(tmp_path / "offsets")
    land(landing, "trip_updates", "a", "20251114_100000", "t1", "t2")
    land(landing / "sub", "vehicle_positions", "a", "20251114_100000", "p1")
    (landing / "gtfs_rt_trip_updates_a_20251114_100020.json").write_text("{")
    ingest_once(spark, str(landing), base, offsets, quarantine_dir=str(tmp_path / "bad"))
    first = [("a", "20251114", "t1"), ("a", "20251114", "t2")]
    assert trips(spark, base) == first and trips(spark, base, "vehicle_positions") == [("a", "20251114", "p1")]
    assert spark.read.parquet(str(tmp_path / "bad")).select("status").collect()[0][0] == "bad_json"
    ingest_once(spark, str(landing), base, offsets)
    assert trips(spark, base) == first
    # A late file of the same date, and a new date.
    land(landing, "trip_updates", "a", "20251114_095940", "t0")
    land(landing, "trip_updates", "a", "20251115_000000", "t9")
    cli.main(["ingest", "--landing", str(landing), "--output-dir", base, "--checkpoint", offsets, "--once"])
    assert trips(spark, base) == sorted([("a", "20251114", "t0"), *first, ("a", "20251115", "t9")])


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    from feedloom.operators.flatten import flatten
    from feedloom.sources.bronze import append_bronze_batch
    from feedloom.sources.snapshots import documents_from_names, read_snapshot_files

    landing, base = tmp_path / "landing", str(tmp_path / "bronze")
    land(landing, "trip_updates", "a", "20251114_100000", "t1")
    rows = flatten(documents_from_names(read_snapshot_files(spark, str(landing), "trip_updates")), "trip_updates")
    for batch_id in (0, 1, 1):
        append_bronze_batch(rows, base, "trip_updates", batch_id)
    assert len(trips(spark, base)) == 2


def test_continuous_ingestion_picks_up_new_files(spark, tmp_path):
    landing, base = tmp_path / "landing", str(tmp_path / "bronze")
    land(landing, "trip_updates", "a", "20251114_100000", "t1")
    (query,) = stream_bronze(spark, str(landing), base, str(tmp_path / "offsets"), "trip_updates", interval=1)
    try:
        query.processAllAvailable()
        land(landing, "trip_updates", "a", "20251114_100020", "t2")
        query.processAllAvailable()
    finally:
        query.stop()
    assert [t[2] for t in trips(spark, base)] == ["t1", "t2"]


def test_schedules_come_first_and_again(spark, tmp_path):
    landing, calls = tmp_path / "landing", []
    for i in range(4):
        land(landing, "trip_updates", "a", f"20251114_1000{i}0", f"t{i}")
    queries = stream_with_static(
        spark, str(landing), str(tmp_path / "bronze"), str(tmp_path / "offsets"), lambda: calls.append(1),
        selection="trip_updates", once=True, files_per_batch=2,
    )
    assert calls
    for query in queries:
        query.awaitTermination()
    assert len(calls) == 2 and len(trips(spark, str(tmp_path / "bronze"))) == 4


def test_minute_counts_take_late_rows_and_open_minutes(spark, tmp_path):
    source, output = tmp_path / "source", str(tmp_path / "out")
    schema = "agency STRING, snapshot_ts_jst TIMESTAMP_NTZ"

    def add(*times):
        rows = spark.createDataFrame([("a", t) for t in times], "agency STRING, t STRING")
        rows.select("agency", F.col("t").cast("timestamp_ntz").alias("snapshot_ts_jst")).coalesce(1).write.mode("append").parquet(str(source))

    def drain():
        stream = spark.readStream.schema(schema).parquet(str(source))
        stream_minute_counts(stream, output, str(tmp_path / "offsets"), once=True).awaitTermination()
        return sorted((str(r.minute)[11:16], r.n) for r in read_minute_counts(spark, output).collect())

    add("2025-11-14 00:00:10", "2025-11-14 00:00:50", "2025-11-14 00:01:10", "2025-11-14 00:05:00")
    assert drain() == [("00:00", 2), ("00:01", 1), ("00:05", 1)]
    add("2025-11-14 00:00:20", "2025-11-14 00:04:30", "2025-11-14 00:09:00")
    whole = [("00:00", 3), ("00:01", 1), ("00:04", 1), ("00:05", 1), ("00:09", 1)]
    assert drain() == whole
    compact_minute_counts(spark, output, str(tmp_path / "compact"))
    assert sorted((str(r.minute)[11:16], r.n) for r in read_minute_counts(spark, str(tmp_path / "compact")).collect()) == whole


def test_one_query_owns_the_schedule_refresh(spark, tmp_path):
    import zipfile

    landing, bundles, schedule = tmp_path / "landing", tmp_path / "bundles", str(tmp_path / "schedule")
    bundles.mkdir()
    with zipfile.ZipFile(bundles / "one.zip", "w") as z:
        z.writestr("stop_times.txt", "trip_id,stop_id,departure_time\n" + "".join(f"t{i},s,10:00:00\n" for i in range(100)))
    for i in range(4):
        land(landing, "trip_updates", "a", f"20251114_1000{i}0", f"t{i}")
        land(landing, "vehicle_positions", "a", f"20251114_1000{i}0", f"t{i}")
    calls = []

    def refresh():
        calls.append(1)
        normalise.refresh_static_tables(spark, str(bundles), schedule)

    place = (spark, str(landing), str(tmp_path / "bronze"), str(tmp_path / "offsets"))
    for query in stream_with_static(*place, refresh, selection="both", once=True, files_per_batch=1):
        query.awaitTermination()
    assert len(calls) == 4  # before the start, and with batches 1 to 3 of one query
    assert normalise.read_static_tables(spark, schedule).count() == 100


def test_files_move_once_they_are_taken_in(spark, tmp_path):
    landing, base, offsets, done = tmp_path / "landing", str(tmp_path / "bronze"), str(tmp_path / "offsets"), tmp_path / "done"
    done.mkdir()
    for i in range(3):
        land(landing, "trip_updates", "a", f"20251114_1000{i}0", f"t{i}")
        cli.main(["ingest", "--landing", str(landing), "--output-dir", base, "--checkpoint", offsets, "--feed-type", "trip_updates",
                  "--once", "--archive-dir", str(done)])
    assert [t[2] for t in trips(spark, base)] == ["t0", "t1", "t2"]
    assert 1 <= len(list(done.rglob("*.json"))) and len(list(landing.rglob("*.json"))) < 3


def test_compaction_rewrites_touched_dates_into_fewer_files(spark, tmp_path):
    from pathlib import Path

    from feedloom.sources.bronze import compact_bronze

    landing, live, closed, offsets = tmp_path / "landing", str(tmp_path / "live"), str(tmp_path / "closed"), str(tmp_path / "offsets")
    for i in range(4):
        land(landing, "trip_updates", "a", f"20251114_1000{i}0", f"t{i}")
        land(landing, "trip_updates", "a", f"20251115_1000{i}0", f"u{i}")
        ingest_once(spark, str(landing), live, offsets, "trip_updates")
    compact_bronze(spark, live, closed, "trip_updates", "20251115")
    assert trips(spark, closed) == [t for t in trips(spark, live) if t[1] == "20251114"]
    count = lambda base: len(list(Path(base).rglob("date_str_jst=20251114/**/*.parquet")))
    assert count(live) == 4 and count(closed) == 1
    land(landing, "trip_updates", "a", "20251114_110000", "late")
    ingest_once(spark, str(landing), live, offsets, "trip_updates")
    before = [p.name for p in Path(closed).rglob("*.parquet")]
    compact_bronze(spark, live, closed, "trip_updates", "20251115", since_batch=4)
    assert [p.name for p in Path(closed).rglob("*.parquet")] == before
    compact_bronze(spark, live, closed, "trip_updates", "20251115", since_batch=3)
    assert [t[2] for t in trips(spark, closed)] == ["late", "t0", "t1", "t2", "t3"]
