"""Row filters and projections over bronze rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.clock import lenient_ts, minute_of_day
from feedloom.sources.schemas import FEED_TYPES

# The columns a map needs.
MAP_COLUMNS = ("lat", "lon", "snapshot_ts_jst", "vehicle_id", "route_id")


def project_map_points(vp: DataFrame) -> DataFrame:
    return vp.select(*MAP_COLUMNS).dropna(subset=["lat", "lon"])


def with_named_coordinates(vp: DataFrame) -> DataFrame:
    return vp.withColumns({"latitude": F.col("lat"), "longitude": F.col("lon")})


def drop_null_positions(vp: DataFrame) -> DataFrame:
    return with_named_coordinates(vp).dropna(subset=["latitude", "longitude"])


def _minutes(clock: str) -> int:
    hours, minutes = clock.split(":")
    return int(hours) * 60 + int(minutes)


def service_hours(df: DataFrame, ts: str, start: str = "05:30", end: str = "23:59") -> DataFrame:
    """Rows whose wall-clock minute lies in [start, end], both minutes included."""
    return df.where(minute_of_day(F.col(ts)).between(_minutes(start), _minutes(end)))


def service_day(df: DataFrame, ts: str, day: date) -> DataFrame:
    """Rows of one calendar day, as a range on the bare column so that it reaches the scan.

    On bronze rows the date partition is named too, so other days are not listed or read.
    """
    begin = F.lit(day.isoformat()).cast("timestamp_ntz")
    end = F.lit(date.fromordinal(day.toordinal() + 1).isoformat()).cast("timestamp_ntz")
    rows = df.where((F.col(ts) >= begin) & (F.col(ts) < end))
    if ts == "snapshot_ts_jst" and "date_str_jst" in df.columns:
        rows = rows.where(F.col("date_str_jst") == day.strftime("%Y%m%d"))
    return rows


def parse_or_drop_ts(df: DataFrame, column: str, formats: Sequence[str] = ()) -> DataFrame:
    """Replace a text column by its time and drop rows whose text names none."""
    return df.withColumn(column, lenient_ts(F.col(column), formats)).where(F.col(column).isNotNull())


def agency_list(agencies: str) -> list[str]:
    return [a.strip() for a in agencies.split(",")]


def agency_filter(df: DataFrame, agencies: str | None) -> DataFrame:
    """One agency or a comma-separated list; nothing or an empty text keeps all."""
    if not agencies:
        return df
    return df.where(F.col("agency").isin(agency_list(agencies)))


def feed_types(selection: str) -> tuple[str, ...]:
    """Feed types a selection stands for: one of them, or both / realtime / all."""
    if selection in ("both", "realtime", "all"):
        return FEED_TYPES
    if selection not in FEED_TYPES:
        raise ValueError(f"unknown feed type: {selection}")
    return (selection,)


def feed_filter(df: DataFrame, selection: str) -> DataFrame:
    return df.where(F.col("feed_type").isin(*feed_types(selection)))


def quiet_hours(df: DataFrame, ts: str, resume_hour: int = 5) -> DataFrame:
    """Leave out the hours before collection resumes."""
    return df.where(F.hour(ts) >= resume_hour)
