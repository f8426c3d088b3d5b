"""Headways: ties, copies, nulls, skew, and the shape of the plan."""

import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from feedloom.operators import headway
from feedloom.plans.views import view


def frame(spark, *rows):
    return spark.createDataFrame(rows, "trip_id STRING, stop_id STRING, departure_time STRING")


def clock(seconds):
    return f"{seconds // 3600:02d}:{seconds // 60 % 60:02d}:{seconds % 60:02d}"


def brute_force(rows):
    groups = defaultdict(list)
    for trip, stop, text in rows:
        parts = trip.split("_")
        groups[(parts[2] if len(parts) > 2 else None, stop)].append(
            int(text[:2]) * 3600 + int(text[3:5]) * 60 + int(text[6:8]) if text else None
        )
    result = {}
    for key, times in groups.items():
        known = sorted(t for t in times if t is not None)
        result[key] = [b - a for a, b in zip(known, known[1:])]
    return result


def awkward_rows():
    rows = [(f"wd_a_r{i % 2}_{i}", f"s{i % 3}", clock((i * 7919) % 5000 + 80000)) for i in range(2000)]
    rows += [("wd_a_hot_1", "s0", clock(100 + i % 40)) for i in range(4000)]  # copies of a few rows
    rows += [(f"wd_a_tie_{i}", "s0", "10:00:00") for i in range(500)]
    rows += [("a_b", "s0", "10:00:00"), ("c_d", "s0", "11:00:00"), ("wd_a_one_1", "s9", "25:10:05")]
    rows += [("wd_a_r0_x", "s0", None), ("wd_a_r0_y", "s0", None), ("wd_a_nul_1", "s0", None)]
    return rows


def test_every_row_keeps_its_headway(spark):
    rows = awkward_rows()
    got = headway.headway(frame(spark, *rows))
    assert got.count() == len(rows)
    by_group = defaultdict(list)
    for r in got.collect():
        if r.headway_s is not None:
            by_group[(r.route_id_extracted, r.stop_id)].append(r.headway_s)
    wanted = {k: sorted(v) for k, v in brute_force(rows).items() if v}
    assert {k: sorted(v) for k, v in by_group.items()} == wanted
    # All rows come back, as often as they went in.
    again = got.groupBy("trip_id", "stop_id", "departure_time").count()
    before = frame(spark, *rows).groupBy("trip_id", "stop_id", "departure_time").count()
    assert again.exceptAll(before).count() == 0 == before.exceptAll(again).count()


def test_stats_equal_brute_force(spark):
    rows = awkward_rows()
    got = {(r.route_id_extracted, r.stop_id): r for r in headway.headway_stats(frame(spark, *rows)).collect()}
    wanted = brute_force(rows)
    assert got.keys() == wanted.keys()
    for key, gaps in wanted.items():
        r = got[key]
        if not gaps:
            assert (r.mean_headway_s, r.median_headway_s, r.std_headway_s, r.cv_headway) == (None,) * 4
            continue
        assert r.mean_headway_s == pytest.approx(statistics.mean(gaps), abs=1e-9)
        assert r.median_headway_s == statistics.median(gaps)
        if len(gaps) > 1:
            assert r.std_headway_s == pytest.approx(statistics.stdev(gaps), rel=1e-12)
        else:
            assert r.std_headway_s is None


def test_by_route_drops_null_routes_and_sorts(spark):
    stats = headway.headway_stats(frame(spark, *awkward_rows()))
    means = headway.headway_by_route(stats).collect()
    assert None not in [m.route_id_extracted for m in means]
    values = [m.mean_headway_s for m in means if m.mean_headway_s is not None]
    assert values == sorted(values, reverse=True)


def test_extra_keys_split_groups(spark):
    rows = frame(spark, ("wd_a_r_1", "s", "10:00:00"), ("we_a_r_1", "s", "10:05:00")).withColumn("day", F.substring("trip_id", 1, 2))
    assert headway.headway_stats(rows).first().mean_headway_s == 300
    assert {r.mean_headway_s for r in headway.headway_stats(rows, ["day"]).collect()} == {None}


def test_stats_plan_has_two_exchanges_and_counts_first(spark, sf_dir):
    plan = headway.headway_stats(view(spark, sf_dir, "stop_times"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    # Below the window there are only counted times, counted before the first exchange.
    lower = plan[plan.index("Window") :]
    assert lower.index("functions=[count(1)]") < lower.index("functions=[partial_count(1)]")
