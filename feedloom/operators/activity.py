"""Activity over time: counts per minute, distinct values, row accounting, down-sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.session import shared_dir


def minute_counts(df: DataFrame, ts: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, minute, n) of the minutes that have records."""
    minute = F.date_trunc("minute", F.col(ts)).cast("timestamp_ntz").alias("minute")
    return df.where(F.col(ts).isNotNull()).groupBy(*by, minute).agg(F.count("*").alias("n"))


def records_per_minute(df: DataFrame, ts: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, minute, n) for every minute between the first and the last record, empty ones 0.

    The minutes are laid out day by day, so a long span is spread over tasks.
    """
    shared_dir(df.sparkSession)
    counts = minute_counts(df, ts, by).checkpoint()  # one row per minute; both sides below read it
    span = counts.groupBy(*by).agg(F.min("minute").alias("first"), F.max("minute").alias("last"))
    one_day, one_minute = F.expr("interval 1 day"), F.expr("interval 1 minute")
    days = span.where("first is not null").select(
        *by,
        "first",
        "last",
        F.explode(F.sequence(F.col("first").cast("date"), F.col("last").cast("date"), one_day)).alias("day"),
    )
    day_start = F.col("day").cast("timestamp_ntz")
    spine = days.repartition(*by, "day").select(
        *by,
        F.explode(
            F.sequence(
                F.greatest("first", day_start), F.least("last", day_start + F.expr("interval '23:59' hour to minute")), one_minute
            )
        ).alias("minute"),
    )
    s, c = spine.alias("s"), counts.alias("c")
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"c.{k}")) for k in (*by, "minute")]
    return s.join(c, same, "left").select("s.*", F.coalesce("c.n", F.lit(0)).cast("bigint").alias("n"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def filter_counts(df: DataFrame, **predicates: Column) -> DataFrame:
    """One row: total rows, and per predicate how many it keeps and how many it drops."""
    measures = [F.count("*").alias("total")]
    for name, predicate in predicates.items():
        measures.append(F.count_if(predicate).alias(f"{name}_kept"))
        measures.append((F.count("*") - F.count_if(predicate)).alias(f"{name}_dropped"))
    return df.agg(*measures)


def downsample_positions(vp: DataFrame, every: str = "1 second", ts: str = "snapshot_ts_jst") -> DataFrame:
    """Per vehicle and time bucket: first position and mean speed, buckets aligned to the epoch.

    Of several rows of one vehicle at the very same time the smallest (latitude, longitude) comes
    first. The tie is settled per place, then per time, by plain minima: every step is a hash
    aggregation with a map-side part, never a sort.
    """
    speeds = [F.sum("_sum").alias("_sum"), F.sum("_speeds").alias("_speeds"), F.sum("n").alias("n")]
    located = vp.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    at_place = located.groupBy("vehicle_id", ts, "lat").agg(
        F.min("lon").alias("lon"), F.sum("speed").alias("_sum"), F.count("speed").alias("_speeds"), F.count("*").alias("n")
    )
    at_once = at_place.groupBy("vehicle_id", ts).agg(F.min("lat").alias("latitude"), F.min_by("lon", "lat").alias("longitude"), *speeds)
    reduced = at_once.groupBy("vehicle_id", F.window(F.col(ts), every)).agg(
        F.min_by("latitude", ts).alias("latitude"), F.min_by("longitude", ts).alias("longitude"), *speeds
    )
    reduced = reduced.withColumn("speed", F.col("_sum") / F.col("_speeds"))
    start = F.col("window.start").cast("timestamp_ntz").alias(ts)
    return reduced.select("vehicle_id", start, "latitude", "longitude", "speed", "n")
