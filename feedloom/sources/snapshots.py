"""Snapshot documents: JSON files in a landing directory, one document per file."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from feedloom.functions.names import (
    UNKNOWN_AGENCY,
    agency_from_feed_name,
    filename_parts,
    snapshot_agency,
    snapshot_name,
)
from feedloom.functions.clock import date_str
from feedloom.operators.documents import document_time, infer_agency
from feedloom.operators.filters import agency_list
from feedloom.sources.schemas import DOCUMENT, LOOSE_DOCUMENT, LOOSE_ITEMS, RAW_LISTS


def document_of(path: Column) -> Column:
    """What makes a document: its path without the ``part-…`` folder that holds a part of it."""
    return F.regexp_replace(path, r"(^|/)part-[0-9]+/", "$1")


def snapshot_glob(feed_type: str) -> str:
    return f"gtfs_rt_{feed_type}_*.json"


def read_snapshot_files(spark: SparkSession, base: str, feed_type: str) -> DataFrame:
    """(snapshot_filename, path, content) of every snapshot of one feed type below ``base``.

    Listing and name matching are the file source's; small files are packed into tasks by
    ``spark.sql.files.maxPartitionBytes`` and ``openCostInBytes``.
    """
    return (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", snapshot_glob(feed_type))
        .text(base, wholetext=True)
        .select(F.col("_metadata.file_name").alias("snapshot_filename"), F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))
    )


def stream_snapshot_files(
    spark: SparkSession, base: str, feed_type: str, files_per_batch: int = 10000, archive_dir: str | None = None
) -> DataFrame:
    """The same frame as an unbounded one: files are picked up as they land.

    With ``archive_dir`` files move there once they are taken in, which keeps the listing of a
    long-lived landing folder short.
    """
    reader = spark.readStream.format("text")
    if archive_dir is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return (
        reader
        .option("wholetext", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", snapshot_glob(feed_type))
        .option("maxFilesPerTrigger", files_per_batch)
        .load(base)
        .select(F.col("_metadata.file_name").alias("snapshot_filename"), F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))
    )


def _parsed(files: DataFrame) -> DataFrame:
    """Add ``doc``. A regular document is parsed once, a document with odd values again."""
    typed = files.withColumn("doc", F.from_json("content", DOCUMENT, {"columnNameOfCorruptRecord": "_corrupt_record"}))
    odd = F.col("doc._corrupt_record").isNotNull()
    return typed.withColumn("doc", F.when(odd, F.expr(_lenient_document())).otherwise(F.col("doc")))


@cache
def _lenient_document() -> str:
    """SQL text that reads values of ``content`` as text and casts them one by one.

    What does not fit is null. A list with an item of the wrong kind is read item by item, so
    that it loses that item only. (Text, because it names some hundred fields.)
    """
    loose, lists = f"from_json(content, '{LOOSE_DOCUMENT}')", f"from_json(content, '{RAW_LISTS}')"
    fields = []
    for field in StructType.fromDDL(DOCUMENT):
        value = f"{loose}.{field.name}"
        if field.name in LOOSE_ITEMS:
            item = f"if(startswith(i, '{{'), from_json(i, '{LOOSE_ITEMS[field.name]}'), null)"
            value = f"coalesce({value}, transform({lists}.{field.name}, i -> {item}))"
        fields.append(f"'{field.name}', {_cast_leaves(value, field.dataType)}")
    return f"named_struct({', '.join(fields)})"


def _cast_leaves(value: str, dtype: DataType) -> str:
    if isinstance(dtype, StructType):
        fields = [f"'{f.name}', {_cast_leaves(f'{value}.{f.name}', f.dataType)}" for f in dtype]
        return f"if({value} is null, null, named_struct({', '.join(fields)}))"
    if isinstance(dtype, ArrayType):
        return f"transform({value}, e -> {_cast_leaves('e', dtype.elementType)})"
    return f"try_cast({value} as {dtype.simpleString()})"


def _status(named: Column) -> Column:
    """``bad_json`` when the parser could read nothing at all of the text."""
    doc = F.col("doc")
    fields = ["feed_type", "timestamp", "header", "entity", "trip_updates", "vehicle_positions", "feed_name"]
    found_something = F.coalesce(*[doc[f].isNotNull() | F.lit(None) for f in fields], F.lit(False))
    whole = doc.isNotNull() & doc["_corrupt_record"].isNull()
    return F.when(~named, "bad_name").when(~(found_something | whole), "bad_json").otherwise("ok")


def _agency(named: Column, first_entity_only: bool) -> Column:
    inferred = F.coalesce(infer_agency(F.col("doc"), first_entity_only), F.lit(UNKNOWN_AGENCY))
    return F.when(named == UNKNOWN_AGENCY, inferred).otherwise(named)


def documents_from_names(files: DataFrame, first_entity_only: bool = False) -> DataFrame:
    """Parse snapshot files whose name carries agency, feed type and time.

    Adds ``status``: ``ok``, ``bad_name`` or ``bad_json``; only ``ok`` documents yield rows. Where
    ``files`` have a ``path``, it tells documents of one name apart; without one each row is its own.
    """
    document = document_of(F.col("path")) if "path" in files.columns else F.lit(None).cast("string")
    named = _parsed(files).withColumn("_parts", filename_parts(F.col("snapshot_filename")))
    return named.select(
        "snapshot_filename",
        F.col("_parts.feed_type").alias("feed_type"),
        F.col("_parts.snapshot_ts_jst").alias("snapshot_ts_jst"),
        F.col("_parts.date_str_jst").alias("date_str_jst"),
        _agency(F.col("_parts.agency"), first_entity_only).alias("agency"),
        F.octet_length("content").cast("bigint").alias("size_bytes"),
        _status(F.col("_parts").isNotNull()).alias("status"),
        document.alias("document"),
        "doc",
    )


def documents_from_members(
    members: DataFrame, first_entity_only: bool = False, utc_as_jst: bool = False
) -> DataFrame:
    """Parse archive members, whose time and agency come from the document itself.

    Input has ``member``, ``feed_type`` and ``content``. ``snapshot_filename`` becomes the
    canonical name. ``utc_as_jst`` keeps the UTC clock reading as if it were local. Where there is a
    ``problem``, the status is ``bad_archive``.
    """
    origin = [F.col(c) for c in ("archive", "member") if c in members.columns]
    document = F.concat_ws("/", *origin)
    broken = F.col("problem").isNotNull() if "problem" in members.columns else F.lit(False)
    named_document = snapshot_name(F.col("feed_type"), F.col("_feed_agency"), F.col("snapshot_ts_jst"))
    timed = _parsed(members).withColumns(
        {
            "snapshot_ts_jst": document_time(F.col("doc"), F.col("feed_type"), utc_as_jst),
            "_feed_agency": agency_from_feed_name(F.col("doc.feed_name")),
        }
    )
    named = F.coalesce("_feed_agency", F.lit(UNKNOWN_AGENCY))
    return timed.select(
        F.when(broken, document).otherwise(named_document).alias("snapshot_filename"),
        "feed_type",
        "snapshot_ts_jst",
        date_str(F.col("snapshot_ts_jst")).alias("date_str_jst"),
        _agency(named, first_entity_only).alias("agency"),
        F.octet_length("content").cast("bigint").alias("size_bytes"),
        F.when(broken, "bad_archive").otherwise(_status(F.lit(True))).alias("status"),
        document.alias("document"),
        "doc",
    )


def keep_agencies(docs: DataFrame, agencies: str | None) -> DataFrame:
    """Mark documents of other agencies ``filtered``, so that they yield no rows.

    A mark and not a filter: the agency may come out of the document, and a filter on it would
    sink below the parse and parse every document again.
    """
    if not agencies:
        return docs
    other = ~F.col("agency").isin(agency_list(agencies))
    return docs.withColumn("status", F.when((F.col("status") == "ok") & other, "filtered").otherwise(F.col("status")))


def of_named_agencies(files: DataFrame, agencies: str | None) -> DataFrame:
    """Leave out files whose name states another agency, before they are parsed."""
    if not agencies:
        return files
    named = snapshot_agency(F.col("snapshot_filename"))
    return files.where(named.isNull() | named.isin([*agency_list(agencies), UNKNOWN_AGENCY]))


def quarantine(docs: DataFrame) -> DataFrame:
    """Documents that yield no rows because of their name or their text, with the reason."""
    report = F.struct("snapshot_filename", "feed_type", "status", "size_bytes")
    # Rows are picked by a generator: as a filter, the condition would be evaluated by parsing again.
    return docs.select(F.inline(F.when(F.col("status").startswith("bad_"), F.array(report))))
