"""Snapshot documents to bronze rows, for both document encodings.

A flat list wins over entities as soon as it is a list, even an empty one. Documents
without rows disappear at the explode; the fixed projection gives the empty table its schema.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.names import blank_to_null
from feedloom.operators.documents import all_fields_null

_TRIP_FIELDS = ("trip_id", "route_id", "direction_id", "start_time", "start_date")
_DOCUMENT_COLUMNS = ("snapshot_filename", "snapshot_ts_jst", "date_str_jst", "agency")


def _items(docs: DataFrame, feed_type: str) -> DataFrame:
    """One row per list item, in column ``flat`` or ``entity``; the other one is null.

    The two lists are exploded side by side and fields are picked afterwards, so all of it
    stays in generated code. Conditions are no filters here, and document columns depend on the
    item position: a filter, written here or by a caller, would otherwise sink below the parse
    and parse every document again.
    """
    usable = (F.col("status") == "ok") & (F.col("feed_type") == feed_type)
    flat = F.when(usable, F.col("doc")[feed_type])
    entity = F.when(usable & F.col("doc")[feed_type].isNull(), F.col("doc.entity"))
    # A missing list must not hide the other.
    zipped = F.arrays_zip(F.coalesce(flat, F.array()).alias("flat"), F.coalesce(entity, F.array()).alias("entity"))
    rows = docs.select(*_DOCUMENT_COLUMNS, F.posexplode(zipped).alias("_pos", "it"))
    return rows.select(*[F.when(F.col("_pos") >= 0, F.col(c)).alias(c) for c in _DOCUMENT_COLUMNS], "it.*")


def _pick(flat: Callable[[Column], Column], entity: Callable[[Column], Column]) -> Column:
    """A field of whichever item the row holds."""
    return F.coalesce(flat(F.col("flat")), entity(F.col("entity")))


def _own_or_nested_id(item: Column) -> Column:
    return F.coalesce(blank_to_null(item["vehicle_id"]), item["vehicle"]["id"])


def _none(_: Column) -> Column:
    return F.lit(None).cast("string")


def _trip_columns(flat: Callable[[str], Callable], entity: str) -> list[Column]:
    return [_pick(flat(name), lambda e, name=name: e[entity]["trip"][name]).alias(name) for name in _TRIP_FIELDS]


def flatten_trip_updates(docs: DataFrame) -> DataFrame:
    """One row per trip update, in bronze column order."""

    def both(name: str, alias: str) -> Column:
        return _pick(lambda item: item[name], lambda e: e["trip_update"][name]).alias(alias)

    return (
        _items(docs, "trip_updates")
        .where(F.col("entity").isNull() | F.col("entity.trip_update").isNotNull())
        .select(
            *_DOCUMENT_COLUMNS,
            _pick(_none, lambda e: e["id"]).alias("entity_id"),
            *_trip_columns(lambda name: lambda item: item[name], "trip_update"),
            _pick(_own_or_nested_id, lambda e: e["trip_update"]["vehicle"]["id"]).alias("vehicle_id"),
            both("timestamp", "tu_timestamp"),
            both("delay", "delay"),
        )
    )


def _entity_vehicle_id(entity: Column) -> Column:
    v = entity["vehicle"]
    nested_missing = all_fields_null(v["vehicle"], ("id", "label", "license_plate"))
    return F.when(nested_missing, v["id"]).otherwise(v["vehicle"]["id"])


def flatten_vehicle_positions(docs: DataFrame, nested_trip_only: bool = False) -> DataFrame:
    """One row per vehicle position, in bronze column order; rows without a position stay.

    ``nested_trip_only`` ignores trip fields written at the top level of a flat item.
    """

    def flat_trip(name: str) -> Callable[[Column], Column]:
        if nested_trip_only:
            return lambda v: v["trip"][name]
        return lambda v: F.coalesce(v["trip"][name], v[name])

    def both(name: str, alias: str) -> Column:
        return _pick(lambda v: v[name], lambda e: e["vehicle"][name]).alias(alias)

    def coordinate(name: str, alias: str) -> Column:
        return _pick(lambda v: v["position"][name], lambda e: e["vehicle"]["position"][name]).alias(alias)

    return (
        _items(docs, "vehicle_positions")
        # An item that is no object is no vehicle, in either list.
        .where(F.col("flat").isNotNull() | F.col("entity.vehicle").isNotNull())
        .select(
            *_DOCUMENT_COLUMNS,
            _pick(_none, lambda e: e["id"]).alias("entity_id"),
            _pick(_own_or_nested_id, _entity_vehicle_id).alias("vehicle_id"),
            *_trip_columns(flat_trip, "vehicle"),
            both("current_stop_sequence", "current_stop_sequence"),
            both("current_status", "current_status"),
            both("timestamp", "vp_timestamp"),
            coordinate("latitude", "lat"),
            coordinate("longitude", "lon"),
            coordinate("bearing", "bearing"),
            coordinate("speed", "speed"),
        )
    )


def flatten(docs: DataFrame, feed_type: str) -> DataFrame:
    return flatten_trip_updates(docs) if feed_type == "trip_updates" else flatten_vehicle_positions(docs)


def document_row_count(feed_type: Column, doc: Column) -> Column:
    """How many rows a document yields, without exploding it."""

    def count(flat: Column, entity_field: str) -> Column:
        entities = F.size(F.filter(doc["entity"], lambda e: e[entity_field].isNotNull()))
        return F.when(flat.isNotNull(), F.size(flat)).otherwise(entities)

    vehicles = F.filter(doc["vehicle_positions"], lambda v: v.isNotNull())
    rows = F.when(feed_type == "trip_updates", count(doc["trip_updates"], "trip_update")).when(
        feed_type == "vehicle_positions", count(vehicles, "vehicle")
    )
    return F.greatest(F.coalesce(rows, F.lit(0)), F.lit(0))
