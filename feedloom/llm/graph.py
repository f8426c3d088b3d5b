"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """(id, root): the smallest id reachable from each id of ``edges`` (a, b), any type that orders.

    Large-star and small-star rounds alternate until nothing changes: each replaces a node's edges
    by edges to its smallest neighbour. Minima are pre-aggregated and joined back, so a hub of any
    degree is never gathered. Lineage ends at a written table each round.
    """
    now = staged(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).where("v <> m").distinct(), "stars")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("m").alias("v"), F.col("v").alias("m")))
        least = both.groupBy("v").agg(F.min("m").alias("least")).select(F.col("v").alias("u"), F.least("v", "least").alias("least"))
        large = both.where("m > v").join(least, F.col("v") == F.col("u")).select(F.col("m").alias("v"), F.col("least").alias("m"))
        down = large.where("v <> m").distinct()
        lowest = down.groupBy("v").agg(F.min("m").alias("least")).select(F.col("v").alias("u"), "least")
        moved = down.join(lowest, F.col("v") == F.col("u"))
        small = moved.select(F.when(F.col("m") == F.col("least"), F.col("v")).otherwise(F.col("m")).alias("v"), F.col("least").alias("m"))
        now = staged(small.where("v <> m").distinct(), "stars")
        seen = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)"))).first())
        if seen == mark:
            break
        mark = seen
    return now.select(F.col("v").alias("id"), F.col("m").alias("root")).unionByName(now.select(F.col("m").alias("id"), F.col("m").alias("root")).distinct())
