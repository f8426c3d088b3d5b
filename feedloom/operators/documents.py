"""What a parsed snapshot document says about itself: its time and its agency."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.clock import JST_OFFSET_HOURS, epoch_to_wall_clock
from feedloom.functions.names import agency_from_vehicle, blank_to_null, first_nonempty


def all_fields_null(struct: Column, fields: tuple[str, ...]) -> Column:
    return F.coalesce(*[struct[f] for f in fields]).isNull()


def _first(values: Column) -> Column:
    """First non-null element of an array, null for an empty or null array."""
    return F.get(F.filter(values, lambda v: v.isNotNull()), 0)


def _entity_vehicle_id(entity: Column) -> Column:
    vehicle = entity["vehicle"]
    nested = F.when(vehicle["vehicle"].isNotNull(), vehicle["vehicle"]["id"]).otherwise(vehicle["id"])
    return first_nonempty(entity["trip_update"]["vehicle"]["id"], nested)


def _flat_position_vehicle_id(item: Column) -> Column:
    vehicle = item["vehicle"]
    absent = all_fields_null(vehicle, ("vehicle_id", "id", "label", "license_plate")) & vehicle["vehicle"].isNull()
    return F.when(absent, first_nonempty(item["vehicle_id"], item["id"])).otherwise(
        first_nonempty(vehicle["vehicle_id"], vehicle["vehicle"]["id"], vehicle["id"])
    )


def infer_agency(doc: Column, first_entity_only: bool = False) -> Column:
    """Agency from the first usable vehicle id: entities, then flat updates, then flat positions.

    ``first_entity_only`` looks at the first entity alone and gives up on a document
    without entities.
    """
    flat = F.coalesce(
        _first(F.transform(doc["trip_updates"], lambda t: first_nonempty(t["vehicle_id"], t["vehicle"]["id"]))),
        _first(F.transform(doc["vehicle_positions"], _flat_position_vehicle_id)),
    )
    if first_entity_only:
        vehicle_id = F.when(
            F.size(doc["entity"]) > 0, F.coalesce(_entity_vehicle_id(F.get(doc["entity"], 0)), flat)
        )
    else:
        vehicle_id = F.coalesce(_first(F.transform(doc["entity"], _entity_vehicle_id)), flat)
    return agency_from_vehicle(blank_to_null(vehicle_id))


def document_time(doc: Column, feed_type: Column, utc_as_jst: bool = False) -> Column:
    """Snapshot time of a document; 1970-01-01 00:00:00 when it states none that is usable."""
    entity_times = F.transform(
        doc["entity"],
        lambda e: F.when(e["trip_update"].isNotNull(), e["trip_update"]["timestamp"]).otherwise(
            e["vehicle"]["timestamp"]
        ),
    )
    first_item = F.when(feed_type == "trip_updates", F.get(doc["trip_updates"], 0)["timestamp"]).when(
        feed_type == "vehicle_positions", F.get(doc["vehicle_positions"], 0)["timestamp"]
    )
    epoch = F.coalesce(doc["timestamp"], doc["header"]["timestamp"], _first(entity_times), first_item)
    offset = 0 if utc_as_jst else JST_OFFSET_HOURS
    return F.coalesce(
        epoch_to_wall_clock(epoch.try_cast("bigint"), offset), F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    )
