"""Scheduled headways per route token and stop.

A departure time is one of at most 362,440 values, so a group of any size shrinks to that
many (time, count) pairs before it is ordered. Every window below runs over such pairs,
never over raw departures.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions.clock import clock_seconds
from feedloom.functions.names import route_token

ROUTE, STOP, DEPARTURE = "route_id_extracted", "stop_id", "departure_time_seconds"
KEYS = (ROUTE, STOP)


def with_departures(stop_times: DataFrame) -> DataFrame:
    return stop_times.withColumns(
        {DEPARTURE: clock_seconds(F.col("departure_time")), ROUTE: route_token(F.col("trip_id"))}
    )


def sort_departures(stop_times: DataFrame) -> DataFrame:
    return with_departures(stop_times).orderBy(ROUTE, STOP, DEPARTURE)


def _distinct_departures(departures: DataFrame, keys: Sequence[str], *extra) -> DataFrame:
    """(keys, departure, n, gap): distinct times with their count and the step from the time before."""
    counted = departures.groupBy(*keys, DEPARTURE).agg(F.count("*").alias("n"), *extra)
    previous = F.lag(DEPARTURE).over(Window.partitionBy(*keys).orderBy(DEPARTURE))
    return counted.withColumn("gap", F.col(DEPARTURE) - previous)


def headway(stop_times: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
    """Every departure with ``headway_s``, the step from the previous departure of its group.

    Of several equal departures one carries the step and the others 0. Copies of a row are
    counted first and repeated at the end, so they meet no window and no join. The join back is
    one row per (keys, time) on its right side; should very many different trips share one
    time, AQE splits their side of it.
    """
    keys = [*KEYS, *extra_keys]
    departures = with_departures(stop_times)
    columns = departures.columns
    copies = departures.groupBy(*columns).agg(F.count("*").alias("_copies"))
    # The row that carries the step: the smallest of the equal departures.
    identity = F.struct(*[c for c in columns if c not in (*keys, DEPARTURE)])
    steps = _distinct_departures(departures, keys, F.min(identity).alias("_carrier"))

    known = copies.where(F.col(DEPARTURE).isNotNull())
    unknown = copies.where(F.col(DEPARTURE).isNull()).withColumn("headway_s", F.lit(None).cast("bigint"))
    r, s = known.alias("r"), steps.where(F.col(DEPARTURE).isNotNull()).alias("s")
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in (*keys, DEPARTURE)]
    row_identity = F.struct(*[F.col(f"r.{c}").alias(c) for c in columns if c not in (*keys, DEPARTURE)])
    matched = r.join(s, same).select(
        "r.*",
        F.when(row_identity == F.col("s._carrier"), F.col("s.gap")).otherwise(F.lit(0).cast("bigint")).alias("_step"),
    )
    repeated = matched.select(
        *columns, "_step", F.posexplode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))).alias("_i", "_copy")
    )
    with_step = repeated.select(
        *columns, F.when(F.col("_i") == 0, F.col("_step")).otherwise(F.lit(0).cast("bigint")).alias("headway_s")
    )
    without = unknown.select(
        *columns, "headway_s", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))).alias("_copy")
    ).drop("_copy")
    return with_step.unionByName(without)


def headway_stats(stop_times: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
    """Mean, median, sample deviation and variation of headways per group.

    n equal departures stand for one step and n-1 zeros, so everything follows from weighted
    steps. Two exchanges: hash(keys, time) after a map-side count, then hash(keys) over the
    distinct times, which the window and the final aggregation share.
    """
    keys = [*KEYS, *extra_keys]
    times = _distinct_departures(with_departures(stop_times), keys)
    zero = F.when(F.col(DEPARTURE).isNotNull(), F.lit(0).cast("bigint"))
    weighted = times.select(
        *keys,
        F.inline(
            F.array(
                F.struct(F.col("gap").alias("h"), F.lit(1).cast("bigint").alias("w")),
                F.struct(zero.alias("h"), (F.col("n") - 1).alias("w")),
            )
        ),
    )
    h, w = F.col("h"), F.col("w")
    sums = weighted.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(h.isNotNull(), w)), F.lit(0)).alias("_n"),
        F.sum(h * w).alias("_sum"),
        F.sum(h * h * w).alias("_squares"),
        F.percentile(h, F.lit(0.5), w).alias("median_headway_s"),
    )
    n, total, squares = (F.col(c).cast("decimal(19,0)") for c in ("_n", "_sum", "_squares"))
    # Exact integer arithmetic up to the last division, so nothing cancels.
    spread = (n * squares - total * total).cast("double")
    mean = F.try_divide(F.col("_sum"), F.col("_n"))
    deviation = F.when(
        F.col("_n") > 1, F.sqrt(spread / F.col("_n").cast("double") / (F.col("_n") - 1).cast("double"))
    )
    return sums.select(*keys, mean.alias("mean_headway_s"), "median_headway_s", deviation.alias("std_headway_s")).withColumn(
        "cv_headway", cv(F.col("std_headway_s"), F.col("mean_headway_s"))
    )


def cv(std: Column, mean: Column) -> Column:
    return F.try_divide(std, mean)


def headway_by_route(stats: DataFrame) -> DataFrame:
    """Mean of the stop means per route, largest first; departures without a route are left out."""
    means = stats.where(F.col(ROUTE).isNotNull()).groupBy(ROUTE).agg(F.avg("mean_headway_s").alias("mean_headway_s"))
    return means.orderBy(F.desc_nulls_last("mean_headway_s"), ROUTE)
