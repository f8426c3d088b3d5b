"""Times of feeds and schedules as Column expressions, independent of the session time zone.

Snapshot times are kept as TIMESTAMP_NTZ wall clock in Japan Standard Time (UTC+9, no
daylight saving). Service times of day may exceed 24:00 and are plain BIGINT seconds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

JST_OFFSET_HOURS = 9
# Years 0001 to 9999, the range a four-digit year can print.
_MIN_EPOCH, _MAX_EPOCH = -62135596800, 253402300799


def _epoch_origin() -> Column:
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'")


def clock_seconds(text: Column, strict: bool = False) -> Column:
    """``HH:MM:SS`` by fixed offsets to seconds; hours beyond 24 are valid.

    The two-digit fields bound the result to 0..362439. Anything else is null, or an
    error with ``strict``.
    """
    seconds = F.when(
        text.rlike(r"^\d{2}.\d{2}.\d{2}"),
        F.substring(text, 1, 2).try_cast("bigint") * 3600
        + F.substring(text, 4, 2).try_cast("bigint") * 60
        + F.substring(text, 7, 2).try_cast("bigint"),
    )
    if strict:
        complaint = F.raise_error(F.concat(F.lit("malformed clock text: "), text)).cast("bigint")
        return F.when(text.isNull(), None).otherwise(F.coalesce(seconds, complaint))
    return seconds


def stamp_to_ts(stamp: Column) -> Column:
    """``YYYYMMDD_HHMMSS`` to wall clock; null when it is not a real date and time."""
    iso = F.regexp_replace(
        stamp, r"^(\d{4})(\d{2})(\d{2})_(\d{2})(\d{2})(\d{2})$", "$1-$2-$3 $4:$5:$6"
    )
    return F.when(stamp.rlike(r"^\d{8}_\d{6}$"), iso.try_cast("timestamp_ntz"))


def ts_text(ts: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS``; by text, so no session zone can shift it."""
    return F.substring(ts.cast("timestamp_ntz").cast("string"), 1, 19)


def date_str(ts: Column) -> Column:
    return F.translate(F.substring(ts_text(ts), 1, 10), "-", "")


def ts_to_stamp(ts: Column) -> Column:
    return F.translate(ts_text(ts), " -:", "_")


def _epoch_decimal(ts: Column, offset_hours: int) -> Column:
    since = (ts.cast("timestamp_ntz") - _epoch_origin()).cast("interval second")
    return since.cast("decimal(20,6)") - F.lit(offset_hours * 3600)


def epoch_ms(ts: Column, offset_hours: int = 0) -> Column:
    """Epoch milliseconds of a wall clock that runs ``offset_hours`` ahead of UTC."""
    return F.floor(_epoch_decimal(ts, offset_hours) * 1000).cast("bigint")


def epoch_seconds(ts: Column, offset_hours: int = 0) -> Column:
    return F.floor(_epoch_decimal(ts, offset_hours)).cast("bigint")


def jst_instant(ts: Column) -> Column:
    """The instant (TIMESTAMP) a JST wall clock names."""
    return F.timestamp_micros((_epoch_decimal(ts, JST_OFFSET_HOURS) * 1000000).cast("bigint"))


def epoch_to_wall_clock(seconds: Column, offset_hours: int = JST_OFFSET_HOURS) -> Column:
    """Epoch seconds to wall clock; null outside the four-digit years."""
    shifted = F.make_dt_interval(F.lit(0), F.lit(offset_hours), F.lit(0), seconds.cast("decimal(18,6)"))
    return F.when(seconds.between(_MIN_EPOCH, _MAX_EPOCH - 86400), _epoch_origin() + shifted)


def lenient_ts(text: Column, formats: Sequence[str] = ()) -> Column:
    """First format that parses, ISO text first; null when none does."""
    attempts = [text.try_cast("timestamp_ntz")]
    attempts += [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*attempts)


def minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)
