"""Order-dependent work on keys of any size.

A window over one key runs in one task, however many rows the key has. Here rows are laid
out in (key, order) sequence over balanced range partitions that cut through large keys, and
the layout is frozen by a checkpoint. Work inside a partition then needs only one small
carried value per (partition, key).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import shared_dir

# monotonically_increasing_id keeps the partition number above this bit.
_PARTITION_BIT = 33


def freeze_order(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows with ``_slice`` (range partition) and ``_pos`` (increases along (keys, order)).

    ``order`` must end in a column that tells rows of a key apart, or copies share a slice.
    The checkpoint is reliable storage: both numbers stay as they are when executors are lost.
    """
    shared_dir(df.sparkSession)
    laid_out = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    frozen = laid_out.withColumn("_pos", F.monotonically_increasing_id()).checkpoint()
    return frozen.withColumn("_slice", F.shiftright("_pos", _PARTITION_BIT))


def with_row_number(frozen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``_t``, the 1-based row number within the key, without a window over rows.

    The side table has one row per (slice, key): at most slices + keys rows.
    """
    spans = frozen.groupBy(*keys, "_slice").agg(F.count("*").alias("_rows"), F.min("_pos").alias("_start"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spans.select(
        *keys, "_slice", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_start") + 1).alias("_shift")
    )
    f, o = frozen.alias("f"), offsets.alias("o")
    same = [F.col(f"f.{k}").eqNullSafe(F.col(f"o.{k}")) for k in (*keys, "_slice")]
    return f.join(o, same).select("f.*", (F.col("f._pos") + F.col("o._shift")).alias("_t"))
