"""Documents in both encodings, their quirks, and what happens to bad ones."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedloom.operators.flatten import flatten_trip_updates, flatten_vehicle_positions
from feedloom.operators.reports import document_log, ingest_report
from feedloom.sources.schemas import TRIP_UPDATES, VEHICLE_POSITIONS
from feedloom.sources.snapshots import documents_from_members, documents_from_names, quarantine

TU = "gtfs_rt_trip_updates_20251114_214913.json"
TU_NAMED = "gtfs_rt_trip_updates_harbour_tram_20251114_214913.json"
VP_NAMED = "gtfs_rt_vehicle_positions_harbour_tram_20251114_214913.json"


def docs_of(spark, *files, **quirks):
    rows = [(name, body if isinstance(body, str) else json.dumps(body, indent=2)) for name, body in files]
    return documents_from_names(spark.createDataFrame(rows, "snapshot_filename STRING, content STRING"), **quirks)


def members_of(spark, *bodies, feed_type="trip_updates", **quirks):
    rows = [(f"m{i}.json", feed_type, b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)]
    return documents_from_members(spark.createDataFrame(rows, "member STRING, feed_type STRING, content STRING"), **quirks)


def test_trip_updates_of_both_encodings(spark):
    flat = {"trip_updates": [{"trip_id": "t1", "route_id": "r", "direction_id": 1, "start_time": "05:00:00", "start_date": "20251114",
                              "vehicle_id": "v1", "timestamp": 176, "delay": -30}]}
    entity = {"header": {"timestamp": 1}, "entity": [
        {"id": "e1", "trip_update": {"trip": {"trip_id": "t2", "direction_id": "1"}, "vehicle": {"id": ""}, "timestamp": "176",
                                     "stop_time_update": [{"stop_id": "x"}]}},
        {"id": "e2", "vehicle": {"trip": {"trip_id": "no"}}},
    ]}
    rows = flatten_trip_updates(docs_of(spark, (TU_NAMED, flat), (TU_NAMED, entity))).orderBy("trip_id").collect()
    ts = datetime(2025, 11, 14, 21, 49, 13)
    assert tuple(rows[0]) == (TU_NAMED, ts, "20251114", "harbour_tram", None, "t1", "r", 1, "05:00:00", "20251114", "v1", 176, -30)
    assert tuple(rows[1]) == (TU_NAMED, ts, "20251114", "harbour_tram", "e1", "t2", None, 1, None, None, "", 176, None)
    assert len(rows) == 2


def test_vehicle_positions_of_both_encodings(spark):
    flat = {"vehicle_positions": [
        {"vehicle_id": "", "vehicle": {"id": "v2"}, "trip_id": "top", "position": {"latitude": 36.5, "longitude": "137.5", "bearing": 0, "speed": 1.5}},
        {"vehicle_id": "v3", "trip": {"trip_id": "nested"}, "trip_id": "top", "position": None, "current_status": 2},
    ]}
    entity = {"entity": [
        {"id": "a", "vehicle": {"id": "own", "trip": {"trip_id": "t"}}},
        {"id": "b", "vehicle": {"id": "own", "vehicle": {"id": "inner"}}},
        {"id": "c", "vehicle": {"id": "own", "vehicle": {}}},
        {"id": "d", "vehicle": {"id": "own", "vehicle": {"label": "L"}}},
        {"id": "e", "trip_update": {}},
    ]}
    docs = docs_of(spark, (VP_NAMED, flat), (VP_NAMED, entity))
    rows = flatten_vehicle_positions(docs).select("entity_id", "vehicle_id", "trip_id", "current_status", "lat", "lon", "bearing", "speed").collect()
    assert [tuple(r) for r in rows] == [
        (None, "v2", "top", None, 36.5, 137.5, 0.0, 1.5),
        (None, "v3", "nested", 2, None, None, None, None),
        ("a", "own", "t", None, None, None, None, None),
        ("b", "inner", None, None, None, None, None, None),
        ("c", "own", None, None, None, None, None, None),
        ("d", None, None, None, None, None, None, None),
    ]
    nested_only = flatten_vehicle_positions(docs, nested_trip_only=True).where("entity_id is null").select("trip_id").collect()
    assert [r[0] for r in nested_only] == [None, "nested"]


def test_empty_flat_list_wins_over_entities(spark):
    both = {"trip_updates": [], "entity": [{"id": "1", "trip_update": {"trip": {"trip_id": "t"}}}]}
    null_list = {"trip_updates": None, "entity": [{"id": "1", "trip_update": {"trip": {"trip_id": "t"}}}]}
    assert flatten_trip_updates(docs_of(spark, (TU_NAMED, both))).count() == 0
    assert flatten_trip_updates(docs_of(spark, (TU_NAMED, null_list))).count() == 1


@pytest.mark.parametrize("function, schema", [(flatten_trip_updates, TRIP_UPDATES), (flatten_vehicle_positions, VEHICLE_POSITIONS)])
def test_empty_table_keeps_the_bronze_schema(spark, function, schema):
    empty = function(docs_of(spark, (TU_NAMED, {"entity": []})))
    wanted = spark.createDataFrame([], schema).schema
    assert [(f.name, f.dataType) for f in empty.schema] == [(f.name, f.dataType) for f in wanted]
    assert empty.count() == 0


def agency_of(spark, body, **quirks):
    return docs_of(spark, (TU, body), **quirks).first().agency


def test_agency_inference(spark):
    flat = {"trip_updates": [{"vehicle_id": None}, {"vehicle_id": "harbour_bus-5007"}]}
    second = {"entity": [{"id": "1", "trip_update": {"vehicle": {"id": ""}}}, {"id": "2", "vehicle": {"vehicle": {"id": "harbour.tram.1"}}}]}
    assert agency_of(spark, flat) == "harbour_bus"
    assert agency_of(spark, flat, first_entity_only=True) == "unknown"
    assert agency_of(spark, second) == "harbour_tram"
    assert agency_of(spark, second, first_entity_only=True) == "unknown"
    # An empty first entity lets the flat lists speak in both modes.
    mixed = {"entity": [{"id": "1"}], "vehicle_positions": [{"vehicle": {"id": "q"}}]}
    assert agency_of(spark, mixed) == "q" == agency_of(spark, mixed, first_entity_only=True)
    assert agency_of(spark, {"entity": [{"id": "1", "vehicle": {"id": "own", "vehicle": {}}}]}) == "unknown"
    assert agency_of(spark, {"vehicle_positions": [{"id": "solo_1_2"}]}) == "solo_1"
    assert docs_of(spark, (TU_NAMED, flat)).first().agency == "harbour_tram"


def test_document_time(spark):
    def times(*bodies, feed_type="trip_updates", **quirks):
        docs = members_of(spark, *bodies, feed_type=feed_type, **quirks)
        return [str(r.snapshot_ts_jst) for r in docs.orderBy("snapshot_filename").collect()]

    tram = {"feed_name": "a", "timestamp": 1763124553}
    assert times(tram) == ["2025-11-14 21:49:13"]
    assert times(tram, utc_as_jst=True) == ["2025-11-14 12:49:13"]
    assert times({"timestamp": None, "header": {"timestamp": "1763124553"}}) == ["2025-11-14 21:49:13"]
    assert times({"timestamp": 0, "header": {"timestamp": 1763124553}}) == ["1970-01-01 09:00:00"]
    assert times({"entity": [{"trip_update": {}, "vehicle": {"timestamp": 5}}, {"vehicle": {"timestamp": 1763124553}}]}) == ["2025-11-14 21:49:13"]
    assert times({"trip_updates": [{"trip_id": "t"}, {"timestamp": 1763124553}]}) == ["1970-01-01 00:00:00"]
    assert times({"trip_updates": [{"timestamp": 1763124553}]}) == ["2025-11-14 21:49:13"]
    assert times({"trip_updates": [{"timestamp": 1763124553}]}, feed_type="vehicle_positions") == ["1970-01-01 00:00:00"]
    assert times({"timestamp": "noon"}, {}) == ["1970-01-01 00:00:00"] * 2


def test_canonical_names(spark):
    got = members_of(spark, {"feed_name": "harbour-tram.x", "timestamp": 1763124553}, {"feed_name": "", "timestamp": 1763124553}).collect()
    assert [r.snapshot_filename for r in got] == [
        "gtfs_rt_trip_updates_harbour_tram_x_20251114_214913.json", "gtfs_rt_trip_updates_20251114_214913.json"
    ]
    assert [r.agency for r in got] == ["harbour_tram_x", "unknown"]


def test_bad_documents_go_to_quarantine(spark):
    good = {"trip_updates": [{"trip_id": "t"}, "not an object", {"trip_id": {"odd": 1}}]}
    docs = docs_of(
        spark,
        (TU_NAMED, good),
        ("gtfs_rt_trip_updates_20251399_000000.json", good),
        (TU_NAMED, json.dumps(good)[:-3]),
        (TU_NAMED, ""),
        (TU_NAMED, "[1, 2]"),
        (TU_NAMED, "{}"),
    )
    bad = [tuple(r) for r in quarantine(docs).groupBy("status").count().orderBy("status").collect()]
    assert bad == [("bad_json", 3), ("bad_name", 1)]
    # An item that is no object still is a row, as nothing but nulls; the others are whole.
    assert [r.trip_id for r in flatten_trip_updates(docs).collect()] == ["t", None, '{"odd":1}']


def test_one_bad_entity_does_not_sink_its_file(spark):
    body = {"entity": ["odd", 7, {"id": "1", "vehicle": {"id": "a_b_1", "position": 5}}, {"id": "2", "vehicle": {"id": "a_b_2"}}]}
    flat = {"timestamp": 5, "vehicle_positions": ["odd", {"vehicle_id": "a_b_3"}]}
    rows = flatten_vehicle_positions(docs_of(spark, (VP_NAMED, body), (VP_NAMED, flat))).collect()
    assert [(r.entity_id, r.vehicle_id, r.lat) for r in rows] == [("1", "a_b_1", None), ("2", "a_b_2", None), (None, "a_b_3", None)]


def test_ingest_report(spark):
    body = {"trip_updates": [{"trip_id": "t", "vehicle_id": "a_b_1"}]}
    docs = docs_of(spark, (TU, body), (TU_NAMED, body), (TU_NAMED, {"trip_updates": []}), (TU_NAMED, "{"), (VP_NAMED, {"vehicle_positions": [{}]}))
    report = {r.agency: r for r in ingest_report(document_log(docs, "a_b, elsewhere")).collect()}
    assert (report["a_b"].trip_updates, report["a_b"].processed) == (1, 1)
    # Counted before the filter, skipped because of it.
    assert (report["harbour_tram"].trip_updates, report["harbour_tram"].vehicle_positions, report["harbour_tram"].skipped) == (1, 1, 2)
    total = report[None]
    assert (total.documents, total.processed, total.skipped) == (5, 1, 4)
    assert total.bytes == docs.agg(F.sum("size_bytes")).first()[0]


def test_a_whole_document_is_parsed_once(spark):
    docs = docs_of(spark, (TU, {"entity": []})).where("agency = 'a'")
    plan = flatten_trip_updates(docs_of(spark, (TU, {"entity": []})))._jdf.queryExecution().executedPlan().toString()
    # The regular parse has numeric leaves; the lenient one sits behind a condition.
    regular = [line for line in plan.splitlines() if "from_json(StructField(feed_type,StringType,true), StructField(timestamp,LongType" in line]
    assert len(regular) == 1
    assert docs.count() == 0
