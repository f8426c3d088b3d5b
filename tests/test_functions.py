"""Scalar functions on hand-written edge cases."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedloom.functions import actions, clock, names


def evaluate(spark, values, function, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v")).alias("r")).collect()]


def test_filename_parts(spark):
    got = evaluate(
        spark,
        [
            "gtfs_rt_trip_updates_harbour_tram_20251114_214913.json",
            "gtfs_rt_vehicle_positions_20251114_214913.json",
            "gtfs_rt_trip_updates_20251399_000000.json",
            "gtfs_rt_alerts_x_20251114_214913.json",
            "gtfs_rt_trip_updates_a_20251114_214913.json.bak",
        ],
        names.filename_parts,
    )
    when = datetime(2025, 11, 14, 21, 49, 13)
    assert tuple(got[0]) == ("harbour_tram", "trip_updates", when, "20251114")
    assert tuple(got[1]) == ("unknown", "vehicle_positions", when, "20251114")
    assert got[2:] == [None, None, None]


def test_agency_from_vehicle(spark):
    got = evaluate(spark, ["harbour_bus-5007", "harbour.tram.1", "x", "a-b", "", None], names.agency_from_vehicle)
    assert got == ["harbour_bus", "harbour_tram", "x", "a_b", None, None]


def test_route_token(spark):
    assert evaluate(spark, ["wd_a_r1_7", "a_b", "a_b_c", "", None], names.route_token) == ["r1", None, "c", None, None]


def test_feed_label(spark):
    urls = [
        "https://feeds.example.org/city/tram/TripUpdates.pb",
        "https://api.example.org/v2/feeds/bus-1/files/feed.v2.zip?rid=current",
        "https://feeds.example.org/",
        "https://feeds.example.org:8443",
        "https://h.example/a/b/;v=1",
        "",
        None,
    ]
    got = evaluate(spark, urls, names.feed_label)
    assert got == [
        "TripUpdates", "feed_v2", "feeds_example_org", "feeds_example_org:8443", "b", "gtfs_static", None
    ]


def test_classify_feed(spark):
    got = evaluate(spark, ["a/trip_updates/1.json", "vehicle_position_trip_update.json", "vehicle_positions.json", "alerts.json"], names.classify_feed)
    assert got == ["trip_updates", "trip_updates", "vehicle_positions", None]


def test_clock_seconds(spark):
    texts = ["25:10:05", "7:05:00", "00:00:00", "", "ab:cd:ef", None, "99:99:99"]
    assert evaluate(spark, texts, clock.clock_seconds) == [90605, None, 0, None, None, None, 362439]
    with pytest.raises(Exception, match="malformed clock text"):
        evaluate(spark, ["7:05:00"], lambda c: clock.clock_seconds(c, strict=True))
    assert evaluate(spark, ["07:05:00", None], lambda c: clock.clock_seconds(c, strict=True)) == [25500, None]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # The second wall clock does not exist in New York.
        for text, epoch in (("2025-11-14 21:49:13", 1763124553), ("2025-03-09 02:30:00", 1741455000)):
            row = (
                spark.range(1)
                .select(F.lit(text).cast("timestamp_ntz").alias("ts"))
                .select(
                    clock.ts_text(F.col("ts")).alias("text"),
                    clock.date_str(F.col("ts")).alias("day"),
                    F.unix_seconds(clock.jst_instant(F.col("ts"))).alias("instant"),
                    clock.epoch_ms(F.col("ts"), 9).alias("ms"),
                    clock.ts_text(clock.epoch_to_wall_clock(clock.epoch_seconds(F.col("ts"), 9))).alias("back"),
                    clock.ts_text(clock.stamp_to_ts(clock.ts_to_stamp(F.col("ts")))).alias("stamped"),
                )
                .first()
            )
            assert (row.text, row.day, row.instant) == (text, text[:10].replace("-", ""), epoch)
            assert (row.ms, row.back, row.stamped) == (epoch * 1000, text, text)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_lenient_ts(spark):
    texts = ["2025-11-14 21:49:13", "14/11/2025 21:49", "soon", None]
    got = evaluate(spark, texts, lambda c: clock.lenient_ts(c, ["dd/MM/yyyy HH:mm"]))
    assert got == [datetime(2025, 11, 14, 21, 49, 13), datetime(2025, 11, 14, 21, 49), None, None]


def test_artifact_names(spark):
    rows = spark.createDataFrame(
        [("rt_json", "trip_updates", "tram", "s"), ("rt_raw", "trip_updates", None, "s"), ("static_json", "", "tram", "s"), ("static_raw", "", None, "s")],
        "kind STRING, feed STRING, label STRING, stamp STRING",
    )
    got = [r[0] for r in rows.select(names.artifact_name(*map(F.col, rows.columns))).collect()]
    assert got == ["gtfs_rt_trip_updates_tram_s.json", "gtfs_rt_trip_updates_trip_updates_s.pb", "gtfs_static_tram_s.json", "gtfs_static_s.zip"]


def test_action_values(spark):
    df = spark.createDataFrame([([1.0, 5.0, 5.0], [1.0, 0.0, 1.0]), ([3.0, 3.0, 1.0], [1.0, 1.0, 1.0])], "q ARRAY<DOUBLE>, m ARRAY<DOUBLE>")
    assert [r[0] for r in df.select(actions.masked_argmax(F.col("q"), F.col("m"))).collect()] == [2, 0]
    assert df.select(actions.duelling_q(F.lit(2.0), F.col("m"))).first()[0] == pytest.approx([2 + 1 / 3, 2 - 2 / 3, 2 + 1 / 3])
    assert evaluate(spark, [0.5, -2.0], actions.huber, "double") == [0.125, 1.5]
