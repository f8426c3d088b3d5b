"""First rows, positional slices and fixed-size samples of tables of any size.

A plain ordered limit keeps n rows per input partition and merges them all in one task,
which grows with the table. Here the rows are first cut down by exact counts: the order is
coarsened to a bucket, buckets are counted (map-side, so skew does not matter), and only the
buckets that reach into the wanted positions are kept, finer and finer, until little more
than the wanted rows is left. The bounds arrive as literals and reach the scan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

@dataclass(frozen=True)
class Level:
    """One coarsening of the order.

    ``bucket`` is non-null, never decreases along the order, and has a bounded number of
    values inside one bucket of the level before. ``within`` turns a pair of bucket bounds
    into a row predicate.
    """

    bucket: Column
    within: Callable[[object, object], Column]


def _between(bucket: Column) -> Callable[[object, object], Column]:
    return lambda low, high: bucket.between(F.lit(low), F.lit(high))


def _cut(df: DataFrame, levels: Sequence[Level], start: int, stop: int) -> tuple[DataFrame, int, int]:
    """Drop rows that cannot hold positions [start, stop); returns rows and shifted positions."""
    for level in levels:
        counts = df.groupBy(level.bucket.alias("b")).agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, 0))
        reached = (
            counts.select("b", "n", (upto - F.col("n")).alias("before"))
            .where((F.col("before") < stop) & (F.col("before") + F.col("n") > start))
            .agg(F.min("b").alias("low"), F.max("b").alias("high"), F.min("before").alias("before"), F.sum("n").alias("n"))
            .first()
        )
        if reached["n"] is None:  # the table ends before the first wanted position
            return df.limit(0), 0, 0
        df = df.where(level.within(reached["low"], reached["high"]))
        start, stop = start - reached["before"], stop - reached["before"]
    return df, start, stop


def _iso_text(ts: Column) -> Column:
    """Wall clock as sortable text of fixed width, blank for null (which sorts first)."""
    text = ts.cast("timestamp_ntz").cast("string")
    dotted = F.when(F.length(text) == 19, F.concat(text, F.lit("."))).otherwise(text)
    return F.coalesce(F.rpad(dotted, 26, "0"), F.lit(" " * 26))


def _time_level(ts: Column, length: int, rest: str, unit: str) -> Level:
    """Buckets by a prefix of the time text; the predicate is a range on the bare column."""
    bucket = F.substring(_iso_text(ts), 1, length)

    def within(low: str, high: str) -> Column:
        if not low.strip():
            return bucket.between(F.lit(low), F.lit(high))
        begin, end = (F.lit(b + rest).cast("timestamp_ntz") for b in (low, high))
        return (ts >= begin) & (ts < end + F.expr(f"interval 1 {unit}"))

    return Level(bucket, within)


def tie_break(key: str) -> Column:
    """Order of rows of equal time: by digest of their key, which spreads even over a huge tie."""
    return F.md5(F.col(key).cast("string"))


def _time_levels(ts: Column, key: str) -> list[Level]:
    digest = F.coalesce(F.substring(tie_break(key), 1, 5), F.lit(""))
    exact = _iso_text(ts)
    return [
        _time_level(ts, 13, ":00:00", "hour"),
        _time_level(ts, 19, "", "second"),
        Level(exact, _between(exact)),
        Level(F.concat(exact, digest), _between(F.concat(exact, digest))),
    ]


def slice_rows(df: DataFrame, ts: str, key: str, start: int, stop: int) -> DataFrame:
    """Rows at positions [start, stop) of the order by (time, tie break, key)."""
    cut, low, high = _cut(df, _time_levels(F.col(ts), key), start, stop)
    ordered = cut.orderBy(F.col(ts).asc_nulls_first(), tie_break(key), key)
    return ordered.offset(low).limit(high - low) if low else ordered.limit(high)


def first_n(df: DataFrame, ts: str, key: str, n: int) -> DataFrame:
    return slice_rows(df, ts, key, 0, n)


def head_rows(df: DataFrame, n: int, order: Sequence[str] = ()) -> DataFrame:
    """n rows: the first of ``order``, else any, reading no more partitions than needed."""
    return (df.orderBy(*order) if order else df).limit(n)


def _digest_levels(digest: Column) -> list[Level]:
    coarse, fine = F.substring(digest, 1, 4), F.substring(digest, 1, 9)
    return [Level(coarse, _between(coarse)), Level(fine, _between(fine))]


def sample_digest(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def sample_n(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """Uniform sample of exactly n rows (all rows of a smaller table), the same on any cluster.

    ``key`` identifies a row.
    """
    digest = sample_digest(key, seed)
    cut, _, count = _cut(df, _digest_levels(digest), 0, n)
    return cut.orderBy(digest, key).limit(count)


def smallest_n(df: DataFrame, value: str, key: str, n: int) -> DataFrame:
    """The n rows with the smallest positive value."""
    # 1024 buckets per power of two: at most about two million over all doubles.
    bucket = F.floor(F.log2(F.col(value)) * 1024)
    cut, _, count = _cut(df, [Level(bucket, _between(bucket))], 0, n)
    return cut.orderBy(value, key).limit(count)
