"""Exploration, ranking, reports and bronze filters on edge cases."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from feedloom.operators import activity, filters, ranking, reports
from feedloom.sources import bronze


def at(text):
    return datetime.fromisoformat(f"2025-11-10 {text}")


def positions(spark, *rows):
    return spark.createDataFrame(rows, "vehicle_id STRING, snapshot_ts_jst TIMESTAMP_NTZ, lat DOUBLE, lon DOUBLE, speed DOUBLE")


def test_service_hours(spark):
    times = [at("05:29:59"), at("05:30:00"), at("23:59:59"), at("00:00:00")]
    df = spark.createDataFrame([(t,) for t in times], "ts TIMESTAMP_NTZ")
    assert [r.ts for r in filters.service_hours(df, "ts").collect()] == times[1:3]
    assert [r.ts for r in filters.quiet_hours(df, "ts").collect()] == times[:3]
    assert filters.service_day(df, "ts", date(2025, 11, 10)).count() == 4
    assert filters.service_day(df, "ts", date(2025, 11, 9)).count() == 0


def test_service_day_reaches_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    plan = filters.service_day(events, "ts", date(2024, 1, 10)).select("ts")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan and "ReadSchema: struct<ts:timestamp_ntz>" in plan


def test_minutes_without_records_are_zero(spark):
    df = spark.createDataFrame([("a", at("10:00:30")), ("a", at("10:03:00")), ("a", at("10:03:59")), ("b", at("09:00:00")), (None, at("09:00:00")), ("c", None)],
                               "by STRING, ts TIMESTAMP_NTZ")
    got = sorted((r.by, r.minute.strftime("%H:%M"), r.n) for r in activity.records_per_minute(df.where("by is not null"), "ts", ["by"]).collect())
    assert got == [("a", "10:00", 1), ("a", "10:01", 0), ("a", "10:02", 0), ("a", "10:03", 2), ("b", "09:00", 1)]
    assert activity.records_per_minute(df, "ts", ["by"]).where("by is null").count() == 1
    assert activity.records_per_minute(df.where("false"), "ts").count() == 0


def test_minutes_run_across_days(spark):
    df = spark.createDataFrame([(datetime(2025, 11, 9, 23, 59),), (datetime(2025, 11, 12, 0, 0),)], "ts TIMESTAMP_NTZ")
    minutes = [r.minute for r in activity.records_per_minute(df, "ts").orderBy("minute").collect()]
    assert len(minutes) == 2 * 1440 + 2
    assert all(b - a == timedelta(minutes=1) for a, b in zip(minutes, minutes[1:]))


def test_downsampling_keeps_the_first_position(spark):
    vp = positions(
        spark, ("v", at("10:00:00.900000"), 2.0, 20.0, 3.0), ("v", at("10:00:00.100000"), 1.0, 10.0, 1.0),
        ("v", at("10:00:00.000000"), None, 9.0, 100.0), ("v", at("10:00:01"), 3.0, 30.0, None),
    )
    got = sorted(tuple(r)[2:] for r in activity.downsample_positions(vp).collect())
    assert got == [(1.0, 10.0, 2.0, 2), (3.0, 30.0, None, 1)]


def test_downsampling_settles_ties_without_sorting(spark):
    vp = positions(
        spark, ("v", at("10:00:00"), 2.0, 1.0, 3.0), ("v", at("10:00:00"), 1.0, 9.0, None), ("v", at("10:00:00"), 1.0, 8.0, 5.0),
        (None, at("10:00:00"), 4.0, 4.0, None), ("v", None, 0.0, 0.0, 1.0),
    )
    down = activity.downsample_positions(vp)
    assert sorted((tuple(r)[2:] for r in down.where("snapshot_ts_jst is not null").collect()), key=str) == [(1.0, 8.0, 4.0, 3), (4.0, 4.0, None, 1)]
    plan = down._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 6


def test_filter_counts(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v INT")
    row = activity.filter_counts(df, big=F.col("v") > 2, known=F.col("v").isNotNull()).first()
    assert tuple(row) == (3, 1, 2, 2, 1)


def test_agency_and_feed_selection(spark):
    df = spark.createDataFrame([("a", "trip_updates"), ("b", "vehicle_positions"), ("c", "trip_updates")], "agency STRING, feed_type STRING")
    assert [r.agency for r in filters.agency_filter(df, "a, c").orderBy("agency").collect()] == ["a", "c"]
    assert filters.agency_filter(df, None).count() == 3 == filters.feed_filter(df, "both").count() == filters.feed_filter(df, "realtime").count()
    assert filters.feed_filter(df, "vehicle_positions").count() == 1
    with pytest.raises(ValueError):
        filters.feed_types("alerts")


# --- ranking ------------------------------------------------------------------------------


def hot_table(spark):
    """A third of the rows in one instant, another third in one hour, some without a time."""
    base = F.expr("timestamp_ntz'2025-11-10 10:00:00'")
    step = F.col("id")
    ts = (
        F.when(step % 50 == 49, None)
        .when(step % 3 == 0, base)
        .when(step % 3 == 1, base + F.make_dt_interval(secs=(step % 600 + step % 7 * 0.000001)))
        .otherwise(base + F.make_dt_interval(hours=step % 100))
    )
    return spark.range(3000).withColumn("ts", ts)


def expected_order(df):
    import hashlib

    rows = [(r.ts, r.id) for r in df.collect()]
    low = datetime.min
    return [i for _, i in sorted(rows, key=lambda r: (r[0] or low, hashlib.md5(str(r[1]).encode()).hexdigest()))]


@pytest.mark.parametrize("start, stop", [(0, 10), (50, 70), (0, 1), (900, 1100), (2990, 3000), (2995, 3100), (5000, 5010), (0, 3000)])
def test_slices_equal_a_plain_sort(spark, start, stop):
    df = hot_table(spark)
    got = [r.id for r in ranking.slice_rows(df, "ts", "id", start, stop).collect()]
    assert got == expected_order(df)[start:stop]


def test_cut_leaves_little_more_than_the_slice(spark):
    df = hot_table(spark)
    cut, low, high = ranking._cut(df, ranking._time_levels(F.col("ts"), "id"), 900, 910)
    assert high - low == 10 and cut.count() < 40


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(5000)
    first = {r.id for r in ranking.sample_n(df, "id", 700).collect()}
    again = {r.id for r in ranking.sample_n(df.repartition(7), "id", 700).collect()}
    other = {r.id for r in ranking.sample_n(df, "id", 700, seed=1).collect()}
    assert len(first) == 700 == len(other) and first == again != other
    assert ranking.sample_n(df, "id", 6000).count() == 5000


def test_first_rows_plan_as_top_k(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    plan = ranking.first_n(events, "ts", "event_id", 10)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "LessThan(ts" in plan


# --- reports and bronze --------------------------------------------------------------------


def test_cycles(spark):
    log = spark.createDataFrame([(at("10:00:00"), True, "a"), (at("10:00:00"), False, "b"), (at("10:01:00"), True, "a")], "cycle_ts TIMESTAMP_NTZ, ok BOOLEAN, feed STRING")
    assert sorted(tuple(r)[1:] for r in reports.cycle_success(log).collect()) == [(1, 1), (1, 2)]
    complete = reports.cycle_completeness(log, ["a", "b"], "cycle_ts").orderBy("cycle_ts").collect()
    assert [tuple(r)[1:] for r in complete] == [(2, 2, True), (1, 2, False)]


def bronze_rows(spark, *rows):
    names = "snapshot_filename STRING, agency STRING, date_str_jst STRING, vehicle_id STRING"
    df = spark.createDataFrame(rows, names)
    missing = {"snapshot_ts_jst": "timestamp_ntz", "entity_id": "string", "trip_id": "string", "route_id": "string", "direction_id": "int",
               "start_time": "string", "start_date": "string", "tu_timestamp": "bigint", "delay": "int"}
    return df.withColumns({c: F.lit(None).cast(t) for c, t in missing.items()})


def test_bronze_replaces_only_touched_partitions(spark, tmp_path):
    base = str(tmp_path / "bronze")
    first = bronze_rows(spark, ("f1", "a", "20251110", "1"), ("f1", "a", "20251111", "2"), ("f1", "007", "20251110", "3"), ("f1", None, "20251110", "4"))
    bronze.write_bronze(first, base, "trip_updates")
    bronze.write_bronze(bronze_rows(spark, ("f2", "a", "20251111", "5"), ("f2", "a", "20251111", "5")), base, "trip_updates")
    table = bronze.read_bronze(spark, base, "trip_updates")
    got = sorted((r.agency, r.date_str_jst, r.vehicle_id) for r in table.collect())
    assert got == [("007", "20251110", "3"), ("a", "20251110", "1"), ("a", "20251111", "5"), ("a", "20251111", "5")]
    assert bronze.read_bronze(spark, base, "vehicle_positions").count() == 0
    assert [r.date_str_jst for r in bronze.retention_window(table, 0, "20251111").distinct().collect()] == ["20251111"]
    plan = table.where("agency = 'a' and date_str_jst >= '20251111'")._jdf.queryExecution().executedPlan().toString()
    day = filters.service_day(table, "snapshot_ts_jst", date(2025, 11, 11))._jdf.queryExecution().executedPlan().toString()
    assert "date_str_jst" in day.split("PartitionFilters: [")[1].split("]")[0]
    assert "PartitionFilters: [" in plan and "agency" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_union_is_strict_and_keeps_copies(spark):
    df = spark.range(3)
    assert bronze.union_snapshots(df, df, df).count() == 9
    with pytest.raises(Exception):
        bronze.union_snapshots(df, df.withColumn("x", F.lit(1))).count()
