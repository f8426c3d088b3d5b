"""Names: snapshot files, agencies, routes, feed labels and stored artifacts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.clock import date_str, stamp_to_ts, ts_to_stamp

UNKNOWN_AGENCY = "unknown"

# The snapshot file name formats, with and without an agency part.
SNAPSHOT_NAME_WITH_AGENCY = r"^gtfs_rt_(trip_updates|vehicle_positions)_(.+?)_(\d{8}_\d{6})\.json$"
SNAPSHOT_NAME_PLAIN = r"^gtfs_rt_(trip_updates|vehicle_positions)_(\d{8}_\d{6})\.json$"
# Fixed value: route is the third underscore-separated field of a trip id.
ROUTE_IN_TRIP_ID = r"^[^_]+_[^_]+_([^_]+)"
# What in a member path tells its feed, first match wins.
FEED_MARKS = {"trip_update": "trip_updates", "vehicle_position": "vehicle_positions"}
# Authority and path of a URL, after RFC 3986 appendix B.
_URL = r"^(?:[^:/?#]+:)?(?://([^/?#]*))?([^?#]*)"


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def first_nonempty(*texts: Column) -> Column:
    """First text that is neither null nor empty."""
    return F.coalesce(*[blank_to_null(t) for t in texts])


def snapshot_agency(name: Column) -> Column:
    """Agency part of a snapshot file name, ``unknown`` when absent, null for a foreign name."""
    return F.coalesce(
        blank_to_null(F.regexp_extract(name, SNAPSHOT_NAME_WITH_AGENCY, 2)),
        F.when(name.rlike(SNAPSHOT_NAME_PLAIN), F.lit(UNKNOWN_AGENCY)),
    )


def snapshot_feed_type(name: Column) -> Column:
    return first_nonempty(
        F.regexp_extract(name, SNAPSHOT_NAME_WITH_AGENCY, 1), F.regexp_extract(name, SNAPSHOT_NAME_PLAIN, 1)
    )


def snapshot_ts(name: Column) -> Column:
    return stamp_to_ts(
        first_nonempty(
            F.regexp_extract(name, SNAPSHOT_NAME_WITH_AGENCY, 3), F.regexp_extract(name, SNAPSHOT_NAME_PLAIN, 2)
        )
    )


def filename_parts(name: Column) -> Column:
    """STRUCT<agency, feed_type, snapshot_ts_jst, date_str_jst>, null for a name to reject."""
    ts = snapshot_ts(name)
    parts = F.struct(
        snapshot_agency(name).alias("agency"),
        snapshot_feed_type(name).alias("feed_type"),
        ts.alias("snapshot_ts_jst"),
        date_str(ts).alias("date_str_jst"),
    )
    return F.when(ts.isNotNull(), parts)


def _underscored(text: Column) -> Column:
    return F.translate(text, "-.", "__")


def agency_from_vehicle(vehicle_id: Column) -> Column:
    """First two underscore tokens of a vehicle id once ``-`` and ``.`` count as underscores."""
    tokens = F.split(_underscored(vehicle_id), "_")
    return F.when(vehicle_id != "", F.array_join(F.slice(tokens, 1, 2), "_"))


def route_token(trip_id: Column) -> Column:
    return blank_to_null(F.regexp_extract(trip_id, ROUTE_IN_TRIP_ID, 1))


def feed_label(url: Column) -> Column:
    """Label of a feed address: stem of the last path part, else the host, else ``gtfs_static``."""
    authority = F.regexp_extract(url, _URL, 1)
    path = F.regexp_replace(F.regexp_extract(url, _URL, 2), r";[^/]*$", "")
    leaf = F.regexp_extract(path, r"([^/]+)/*$", 1)
    stem = first_nonempty(F.regexp_extract(leaf, r"^(.+)\.[^.]+$", 1), leaf)
    label = _underscored(first_nonempty(stem, authority))
    return F.when(url.isNotNull(), F.coalesce(label, F.lit("gtfs_static")))


def artifact_name(kind: Column, feed_type: Column, label: Column, stamp: Column) -> Column:
    """Stored name of a payload; ``kind`` is rt_json, rt_raw, static_json or static_raw."""
    realtime = F.concat_ws("_", F.lit("gtfs_rt"), feed_type, first_nonempty(label, feed_type), stamp)
    static = F.concat_ws("_", F.lit("gtfs_static"), blank_to_null(label), stamp)
    return (
        F.when(kind == "rt_json", F.concat(realtime, F.lit(".json")))
        .when(kind == "rt_raw", F.concat(realtime, F.lit(".pb")))
        .when(kind == "static_json", F.concat(static, F.lit(".json")))
        .when(kind == "static_raw", F.concat(static, F.lit(".zip")))
    )


def classify_feed(member_name: Column) -> Column:
    """Feed type by substring of the full member path; null means the member is dropped."""
    return F.coalesce(*[F.when(member_name.contains(mark), F.lit(feed)) for mark, feed in FEED_MARKS.items()])


def agency_from_feed_name(feed_name: Column) -> Column:
    return blank_to_null(F.trim(_underscored(feed_name)))


def snapshot_name(feed_type: Column, agency: Column, ts: Column) -> Column:
    """Snapshot file name; a null agency leaves its part out."""
    return F.concat(F.concat_ws("_", F.lit("gtfs_rt"), feed_type, agency, ts_to_stamp(ts)), F.lit(".json"))
