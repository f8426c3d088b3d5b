"""Reports on ingestion: documents, cycles and schedule tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators.filters import agency_list
from feedloom.operators.flatten import document_row_count
from feedloom.sources.schemas import FEED_TYPES


def document_log(docs: DataFrame, agencies: str | None = None) -> DataFrame:
    """One row per document: what it holds, and whether it is processed or skipped.

    A document is skipped when it is bad, yields no rows, or its agency is filtered out. Parts of
    one document (of equal ``document``) count as one, which is bad if any part is; files of one name
    in different folders are documents of their own, and so is each row without a ``document``.
    """
    rows = document_row_count(F.col("feed_type"), F.col("doc"))
    own = F.concat(F.lit("row "), F.monotonically_increasing_id())
    document = F.coalesce("document", own).alias("document")
    parts = docs.select(document, "feed_type", "agency", "size_bytes", "status", rows.alias("rows"))
    log = parts.groupBy("document").agg(
        F.max("feed_type").alias("feed_type"),
        F.max("agency").alias("agency"),
        F.sum("size_bytes").alias("size_bytes"),
        F.coalesce(F.min(F.when(F.col("status") != "ok", F.col("status"))), F.lit("ok")).alias("status"),
        F.sum("rows").alias("rows"),
    )
    usable = (F.col("status") == "ok") & (F.col("rows") > 0)
    allowed = F.col("agency").isin(agency_list(agencies)) if agencies else F.lit(True)
    return log.withColumns({"usable": usable, "processed": usable & allowed})


def ingest_report(log: DataFrame) -> DataFrame:
    """Documents per agency and feed type, counted before the agency filter, and totals.

    The row with a null agency is the total over all documents.
    """
    per_feed = [F.count_if(F.col("usable") & (F.col("feed_type") == f)).alias(f) for f in FEED_TYPES]
    known = log.withColumn("agency", F.when(F.col("usable"), F.col("agency")).otherwise(F.lit("(none)")))
    return known.rollup("agency").agg(
        *per_feed,
        F.count("*").alias("documents"),
        F.count_if("processed").alias("processed"),
        F.count_if(~F.col("processed")).alias("skipped"),
        F.sum("size_bytes").alias("bytes"),
    )


def cycle_success(log: DataFrame) -> DataFrame:
    """(cycle_ts, ok, total) of a log of feed fetches with columns cycle_ts and ok."""
    return log.groupBy("cycle_ts").agg(F.count_if("ok").alias("ok"), F.count("*").alias("total"))


def cycle_completeness(df: DataFrame, expected: Sequence[str], ts: str = "snapshot_ts_jst", feed: str = "feed") -> DataFrame:
    """Per shared time stamp: which expected feeds are present."""
    present = [F.max((F.col(feed) == f).cast("int")).alias(f"_{i}") for i, f in enumerate(expected)]
    counted = df.groupBy(ts).agg(*present)
    found = sum((F.coalesce(F.col(f"_{i}"), F.lit(0)) for i in range(len(expected))), F.lit(0))
    return counted.select(
        ts, found.alias("feeds_present"), F.lit(len(expected)).alias("feeds_expected"), (found == len(expected)).alias("complete")
    )


def static_profile(rows: DataFrame) -> DataFrame:
    """(table, rows, columns, sample): size, column list and one sample record per schedule table.

    Rows are first counted per header, of which a table has a few, so no list grows with the
    data. The sample is looked for among first lines only.
    """
    per_header = rows.groupBy("table", F.array_sort(F.map_keys("row")).alias("header")).agg(F.count("*").alias("n"))
    sizes = per_header.groupBy("table").agg(
        F.sum("n").alias("rows"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("header")))).alias("columns")
    )
    first_lines = rows.where("line_no = 1").groupBy("table")
    samples = first_lines.agg(F.min(F.struct("archive", F.to_json("row").alias("json")))["json"].alias("sample"))
    return sizes.join(samples, "table", "left")
