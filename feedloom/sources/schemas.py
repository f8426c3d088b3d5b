"""Fixed schemas of documents, bronze tables and static tables."""

from __future__ import annotations

# Feed types, static table names and bronze column order.
FEED_TYPES = ("trip_updates", "vehicle_positions")

STATIC_TABLES = ("agency", "stops", "routes", "trips", "stop_times", "calendar", "calendar_dates")

TRIP_UPDATES = """
    snapshot_filename STRING, snapshot_ts_jst TIMESTAMP_NTZ, date_str_jst STRING, agency STRING,
    entity_id STRING, trip_id STRING, route_id STRING, direction_id INT, start_time STRING,
    start_date STRING, vehicle_id STRING, tu_timestamp BIGINT, delay INT
"""

VEHICLE_POSITIONS = """
    snapshot_filename STRING, snapshot_ts_jst TIMESTAMP_NTZ, date_str_jst STRING, agency STRING,
    entity_id STRING, vehicle_id STRING, trip_id STRING, route_id STRING, direction_id INT,
    start_time STRING, start_date STRING, current_stop_sequence INT, current_status INT,
    vp_timestamp BIGINT, lat DOUBLE, lon DOUBLE, bearing DOUBLE, speed DOUBLE
"""

BRONZE = {"trip_updates": TRIP_UPDATES, "vehicle_positions": VEHICLE_POSITIONS}

STOP_TIMES = "trip_id STRING, stop_id STRING, departure_time STRING"

_ITEMS = {
    "entity": """STRUCT<
        id: STRING,
        trip_update: STRUCT<trip: {trip}, vehicle: {vehicle}, timestamp: {long}, delay: {int}>,
        vehicle: STRUCT<id: STRING, vehicle: {vehicle}, trip: {trip}, position: {position},
            current_stop_sequence: {int}, current_status: {int}, timestamp: {long}>>""",
    "trip_updates": """STRUCT<{trip_fields}, vehicle_id: STRING, vehicle: {vehicle}, timestamp: {long}, delay: {int}>""",
    "vehicle_positions": """STRUCT<vehicle_id: STRING, id: STRING,
        vehicle: STRUCT<vehicle_id: STRING, vehicle: {vehicle}, id: STRING, label: STRING, license_plate: STRING>,
        trip: {trip}, {trip_fields}, current_stop_sequence: {int}, current_status: {int}, timestamp: {long},
        position: {position}>""",
}
_TRIP_FIELDS = "trip_id: STRING, route_id: STRING, direction_id: {int}, start_time: STRING, start_date: STRING"
_VEHICLE = "STRUCT<id: STRING, label: STRING, license_plate: STRING>"
_POSITION = "STRUCT<latitude: {double}, longitude: {double}, bearing: {double}, speed: {double}>"


def item_types(long: str, int_: str, double: str) -> dict[str, str]:
    """Types of the list items of a document, with the given types for numbers."""
    numbers = {"long": long, "int": int_, "double": double}
    trip_fields = _TRIP_FIELDS.format(**numbers)
    parts = {
        "trip_fields": trip_fields,
        "trip": f"STRUCT<{trip_fields}>",
        "vehicle": _VEHICLE,
        "position": _POSITION.format(**numbers),
    }
    return {name: text.format(**parts, **numbers) for name, text in _ITEMS.items()}


def _document(time: str, items: dict[str, str]) -> str:
    lists = ", ".join(f"{name} ARRAY<{item}>" for name, item in items.items())
    return f"""feed_type STRING, timestamp {time}, gtfs_realtime_version STRING, feed_url STRING, feed_name STRING,
        header STRUCT<gtfs_realtime_version: STRING, timestamp: {time}>, {lists}, _corrupt_record STRING"""


# Numbers are expected as numbers, which parses fastest. A document that holds one as text is
# read again with text leaves.
DOCUMENT = _document("BIGINT", item_types("BIGINT", "INT", "DOUBLE"))
LOOSE_ITEMS = item_types("STRING", "STRING", "STRING")
LOOSE_DOCUMENT = _document("STRING", LOOSE_ITEMS)
# The lists with unread items.
RAW_LISTS = ", ".join(f"{name} ARRAY<STRING>" for name in LOOSE_ITEMS)

STATIC_DOCUMENT = "feed_url STRING, feed_name STRING, timestamp STRING, tables MAP<STRING, ARRAY<MAP<STRING, STRING>>>"
