"""Writing documents: realtime snapshots, schedule bundles and raw payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.names import artifact_name
from feedloom.sources.files import write_named_files

def in_parts(rows: DataFrame, keys: Sequence[str], parts: int, of: Sequence[str]) -> DataFrame:
    """Add ``part``: the columns ``of`` decide by hash which of the caller's ``parts`` a row is in.

    Every group gets one more row per part that is null in ``of``, which lists leave out, so that
    each part is written even if empty: storing a group again replaces all of its files.
    """
    dealt = rows.withColumn("part", F.pmod(F.xxhash64(*of), F.lit(parts)).cast("int"))
    if parts == 1:
        return dealt
    groups = rows.select(*[c for c in rows.columns if c not in of]).dropDuplicates(list(keys))
    blank = groups.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return dealt.unionByName(blank, allowMissingColumns=True)


def snapshot_documents(
    items: DataFrame,
    item: Column,
    keys: Sequence[str] = ("feed_type", "label", "stamp"),
    extra: dict[str, Column] = {},
    parts: int = 1,
) -> DataFrame:
    """(name, content, keys…, part): flat JSON documents, one per feed and cycle.

    A caller with large cycles asks for several ``parts``: complete documents of the same name in
    ``part-…`` folders, so that no task holds a whole cycle; reading them back gives every item
    once, and reports count a name once. Keep to one number of parts in a folder. ``extra`` adds
    top-level fields.
    """
    keyed = items.select(*keys, item.alias("_item"), *[c.alias(n) for n, c in extra.items()])
    group = [*keys, *extra, "part"]
    grouped = in_parts(keyed, keys, parts, ["_item"]).groupBy(*group).agg(F.collect_list("_item").alias("_items"))
    documents = {
        feed_type: F.to_json(
            F.struct("feed_type", *extra, F.col("label").alias("feed_name"), F.col("_items").alias(feed_type))
        )
        for feed_type in ("trip_updates", "vehicle_positions")
    }
    content = F.when(F.col("feed_type") == "trip_updates", documents["trip_updates"]).otherwise(
        documents["vehicle_positions"]
    )
    name = artifact_name(F.lit("rt_json"), F.col("feed_type"), F.col("label"), F.col("stamp"))
    return grouped.select(_in_part(name).alias("name"), content.alias("content"), *keys, "part")


def _in_part(name: Column) -> Column:
    return F.when(F.col("part") == 0, name).otherwise(F.concat(F.format_string("part-%06d/", "part"), name))


def static_documents(rows: DataFrame, feed_url: Column | None = None, parts: int = 1) -> DataFrame:
    """(name, content): schedule tables nested in one JSON document per feed.

    Input is (label, stamp, table, line_no, row MAP). ``parts`` is as in
    ``snapshot_documents``. Records keep file order inside a document; those without a line number
    come last, in order of their content. A row with neither number nor record names an empty table.
    """
    keyed = rows.select("label", "stamp", "table", "line_no", "row", (feed_url or F.lit(None).cast("string")).alias("feed_url"))
    numbered = F.struct(F.col("line_no").isNull().alias("late"), "line_no", F.map_entries("row").alias("entries"))
    record = F.when(F.col("line_no").isNotNull() | F.col("row").isNotNull(), numbered)  # else a table without records
    keyed = keyed.select("label", "stamp", "feed_url", "table", record.alias("_record"))
    dealt = in_parts(keyed, ["label", "stamp", "feed_url", "table"], parts, ["_record"])
    per_table = dealt.groupBy("label", "stamp", "feed_url", "part", "table").agg(
        F.sort_array(F.collect_list("_record")).alias("records")
    )
    # Entries instead of maps, because maps have no order to sort by.
    per_table = per_table.withColumn(
        "records", F.transform("records", lambda r: F.map_from_entries(r["entries"]))
    )
    documents = per_table.groupBy("label", "stamp", "feed_url", "part").agg(
        F.map_from_entries(F.collect_list(F.struct("table", "records"))).alias("tables")
    )
    content = F.to_json(
        F.struct("feed_url", F.col("label").alias("feed_name"), F.col("stamp").alias("timestamp"), "tables")
    )
    name = artifact_name(F.lit("static_json"), F.lit(""), F.col("label"), F.col("stamp"))
    return documents.select(_in_part(name).alias("name"), content.alias("content"))


def write_documents(documents: DataFrame, base: str) -> None:
    """Store ``(name, content)`` documents under their own names."""
    write_named_files(documents, base)


def archive_payloads(payloads: DataFrame, path: str, feed_type: str, label: Column, stamp: Column) -> None:
    """Keep raw payloads ``(path, modificationTime, length, content)`` with their stored names."""
    kind = F.lit("static_raw" if feed_type == "static" else "rt_raw")
    stored = artifact_name(kind, F.lit(feed_type), label, stamp).alias("name")
    payloads.select(stored, "path", "modificationTime", "length", "content").write.mode("overwrite").option(
        "compression", "zstd"
    ).parquet(path)
