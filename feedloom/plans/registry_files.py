"""Registered queries: documents, containers, bronze tables and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.operators.flatten import flatten, flatten_trip_updates, flatten_vehicle_positions
from feedloom.operators.reports import document_log, ingest_report, static_profile
from feedloom.plans import fixtures, normalise
from feedloom.plans.registry_schedule import rounded
from feedloom.plans.views import events, view, with_views
from feedloom.session import fresh_dir
from feedloom.sources import bronze, documents, protobuf, snapshots, static
from feedloom.sources.files import read_payloads, write_named_files
from feedloom.streaming.counts import read_minute_counts, stream_minute_counts
from feedloom.streaming.ingest import ingest_once, stream_with_static

QUERIES, ORACLES = {}, {}


def query(key: str, sql: str | None = None):
    def register(function):
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register


def _tu_sql(unit: str, entity_ids: str = "cast(null as varchar)", source: str = "tu") -> str:
    """Bronze trip updates as a plain projection of the view."""
    return f"""select concat('gtfs_rt_trip_updates_', agency, '_', strftime(date_trunc('{unit}', snapshot_ts_jst), '%Y%m%d_%H%M%S'), '.json') as snapshot_filename,
      cast(date_trunc('{unit}', snapshot_ts_jst) as timestamp) as snapshot_ts_jst, strftime(snapshot_ts_jst, '%Y%m%d') as date_str_jst, agency,
      {entity_ids} as entity_id, trip_id, route_id, cast(null as int) as direction_id, cast(null as varchar) as start_time,
      cast(null as varchar) as start_date, vehicle_id,
      cast(floor(epoch(snapshot_ts_jst)) as bigint) - 32400 as tu_timestamp, delay from {source}"""


def _vp_sql(unit: str, entity_ids: str = "cast(null as varchar)", source: str = "vp") -> str:
    return f"""select concat('gtfs_rt_vehicle_positions_', agency, '_', strftime(date_trunc('{unit}', snapshot_ts_jst), '%Y%m%d_%H%M%S'), '.json') as snapshot_filename,
      cast(date_trunc('{unit}', snapshot_ts_jst) as timestamp) as snapshot_ts_jst, strftime(snapshot_ts_jst, '%Y%m%d') as date_str_jst, agency,
      {entity_ids} as entity_id, vehicle_id, trip_id, route_id, cast(null as int) as direction_id, cast(null as varchar) as start_time,
      cast(null as varchar) as start_date, current_stop_sequence, current_status,
      cast(floor(epoch(snapshot_ts_jst)) as bigint) - 32400 as vp_timestamp, round(lat, 6) as lat, round(lon, 6) as lon,
      cast(null as double) as bearing, case when lat is null then null else round(speed, 6) end as speed from {source}"""


_MIXED_ID = "case when agency = 'harbour_bus' then concat('e', cast(event_id as varchar)) end"


def _round_vp(df):
    return rounded(df, "lat", "lon", "speed")


# --- documents in memory -------------------------------------------------------------------


@query("flatten_trip_updates", with_views(_tu_sql("hour", _MIXED_ID), "tu"))
def flatten_tu(spark, sf_dir):
    docs = fixtures.as_files(fixtures.documents(spark, sf_dir, "trip_updates", "hour"))
    return flatten_trip_updates(snapshots.documents_from_names(docs))


@query("flatten_vehicle_positions", with_views(_vp_sql("hour", _MIXED_ID), "vp"))
def flatten_vp(spark, sf_dir):
    docs = fixtures.as_files(fixtures.documents(spark, sf_dir, "vehicle_positions", "hour"))
    return _round_vp(flatten_vehicle_positions(snapshots.documents_from_names(docs)))


def _bytes_sql(feed_type: str, unit: str) -> str:
    """(agency, hr, n, bytes): the size of each flat document, from the JSON text of its items."""
    common = """'","timestamp":', cast(floor(epoch(snapshot_ts_jst)) as bigint) - 32400"""
    if feed_type == "trip_updates":
        source, item = "tu", f"""concat('{{"trip_id":"', trip_id, '","route_id":"', route_id, '","vehicle_id":"', vehicle_id, {common}, ',"delay":' || delay, '}}')"""
    else:
        position = """',"position":{"latitude":' || lat || ',"longitude":' || lon || ',"speed":' || speed || '}'"""
        numbers = """'","current_stop_sequence":', current_stop_sequence, ',"current_status":', current_status"""
        stamp = common.replace("""'",""", "',")
        source, item = "vp", f"""concat('{{"vehicle_id":"', vehicle_id, '","trip_id":"', trip_id, '","route_id":"', route_id, {numbers}, {stamp}, {position}, '}}')"""
    start = f"""concat('{{"feed_type":"{feed_type}","timestamp":', cast(epoch(hr) as bigint) - 32400, ',"feed_name":"', agency, '","{feed_type}":[]}}')"""
    items = f"select agency, date_trunc('{unit}', snapshot_ts_jst) as hr, strlen({item}) as size from {source}"
    return f"select '{feed_type}' as feed, agency, hr, count(*) as n, sum(size) + count(*) - 1 + strlen({start}) as bytes from ({items}) group by 2, 3"


# Documents per agency and hour: one in five truncated, one in seven under a foreign name.
_DAMAGED = f"""select feed, agency, hr, case when n % 7 = 0 then 'bad_name' when n % 5 = 0 then 'bad_json' else 'ok' end as status, n,
    bytes - case when n % 5 = 0 then 9 else 0 end as bytes
  from ({_bytes_sql("trip_updates", "hour")} union all {_bytes_sql("vehicle_positions", "hour")})"""


def _damaged(spark, sf_dir):
    both = [fixtures.flat_documents(fixtures.cycle_rows(spark, sf_dir, f, "hour"), f) for f in ("trip_updates", "vehicle_positions")]
    docs = both[0].unionByName(both[1])
    lists = F.from_json("content", "trip_updates ARRAY<STRUCT<trip_id: STRING>>, vehicle_positions ARRAY<STRUCT<trip_id: STRING>>")
    n = F.size(F.coalesce(lists["trip_updates"], lists["vehicle_positions"]))
    name = F.element_at(F.split("name", "/"), -1)
    return docs.select(
        F.when(n % 7 == 0, F.concat(F.lit("copy-of-"), name)).otherwise(name).alias("snapshot_filename"),
        F.col("name").alias("path"),
        F.when(n % 5 == 0, F.expr("left(content, length(content) - 9)")).otherwise(F.col("content")).alias("content"),
    )


@query("quarantine", with_views(f"select status, count(*) as documents from ({_DAMAGED}) where status <> 'ok' group by 1", "tu", "vp"))
def quarantine_query(spark, sf_dir):
    bad = snapshots.quarantine(snapshots.documents_from_names(_damaged(spark, sf_dir)))
    return bad.groupBy("status").agg(F.count_distinct("snapshot_filename").alias("documents"))


_REPORT_SQL = f"""select agency, cast(sum(trip_updates) as bigint) as trip_updates, cast(sum(vehicle_positions) as bigint) as vehicle_positions,
    cast(sum(1) as bigint) as documents, cast(sum(processed) as bigint) as processed, cast(sum(1 - processed) as bigint) as skipped,
    cast(sum(bytes) as bigint) as bytes
  from (select bytes, case when status = 'ok' then agency else '(none)' end as agency, case when status = 'ok' and feed = 'trip_updates' then 1 else 0 end as trip_updates,
      case when status = 'ok' and feed = 'vehicle_positions' then 1 else 0 end as vehicle_positions,
      case when status = 'ok' and agency = 'harbour_bus' then 1 else 0 end as processed from ({_DAMAGED}))
  group by rollup(agency)"""


@query("ingest_report", with_views(_REPORT_SQL, "tu", "vp"))
def ingest_report_query(spark, sf_dir):
    docs = snapshots.documents_from_names(_damaged(spark, sf_dir))
    return ingest_report(document_log(docs, "harbour_bus"))


# --- files ---------------------------------------------------------------------------------


@query("scan_snapshots", with_views(_tu_sql("day"), "tu"))
def scan_snapshots(spark, sf_dir):
    return normalise.snapshot_rows(spark, fixtures.landing(spark, sf_dir, "trip_updates"), "trip_updates")


@query("snapshot_json_write", with_views(_vp_sql("day"), "vp"))
def snapshot_json_write(spark, sf_dir):
    base = fixtures.landing(spark, sf_dir, "vehicle_positions")
    return _round_vp(normalise.snapshot_rows(spark, base, "vehicle_positions"))


def _archives(spark, sf_dir, feed_type: str, packed: bool) -> str:
    base = fresh_dir(spark, "archives")
    rows = fixtures.cycle_rows(spark, sf_dir, feed_type)
    docs = fixtures.flat_documents(rows, feed_type)
    if not packed:
        fixtures.write_archives(docs, base)
        return base
    fixtures.write_archives(docs.where("label = 'harbour_tram'"), base)
    fixtures.write_archives(docs.where("label <> 'harbour_tram'"), base, "packed", packed=True)
    return base


@query("scan_tar", with_views(_vp_sql("day"), "vp"))
def scan_tar(spark, sf_dir):
    base = _archives(spark, sf_dir, "vehicle_positions", packed=False)
    return _round_vp(flatten(normalise.archive_documents(spark, base, "*.tar"), "vehicle_positions"))


@query("scan_tar_dir", with_views(_tu_sql("day"), "tu"))
def scan_tar_dir(spark, sf_dir):
    base, table = _archives(spark, sf_dir, "trip_updates", packed=True), fresh_dir(spark, "bronze")
    normalise.normalise_archives(spark, base, table, selection="trip_updates")
    return bronze.read_bronze(spark, table, "trip_updates")


def _day_rows(spark, sf_dir, feed_type: str):
    docs = fixtures.flat_documents(fixtures.cycle_rows(spark, sf_dir, feed_type), feed_type)
    return flatten(snapshots.documents_from_names(fixtures.as_files(docs)), feed_type)


@query("bronze_write", with_views(_vp_sql("day"), "vp"))
def bronze_write(spark, sf_dir):
    """Writes all days, then one agency again: only its partitions are replaced, by equal rows."""
    table, rows = fresh_dir(spark, "bronze"), _day_rows(spark, sf_dir, "vehicle_positions")
    bronze.write_bronze(rows, table, "vehicle_positions")
    bronze.write_bronze(rows.where("agency = 'harbour_tram'"), table, "vehicle_positions")
    return _round_vp(bronze.read_bronze(spark, table, "vehicle_positions"))


@query(
    "combined_write",
    with_views("select vehicle_id, count(*) as n, round(sum(speed), 4) as total from vp where agency = 'harbour_tram' group by 1", "vp"),
)
def combined_write(spark, sf_dir):
    path = fresh_dir(spark, "combined")
    bronze.write_combined(view(spark, sf_dir, "vp").where("agency = 'harbour_tram'"), path)
    combined = bronze.read_table(spark, path)
    return combined.groupBy("vehicle_id").agg(F.count("*").alias("n"), F.round(F.sum("speed"), 4).alias("total"))


@query("scan_parquet", "select event_type, count(*) as n, max(ts) as last_ts from events group by 1")
def scan_parquet(spark, sf_dir):
    table = bronze.read_table(spark, f"{sf_dir}/event[s].parquet")
    return table.groupBy("event_type").agg(F.count("*").alias("n"), F.max("ts").alias("last_ts"))


# --- schedules -----------------------------------------------------------------------------


@query("scan_stop_times_csv", with_views("select trip_id, stop_id, departure_time from stop_times", "stop_times"))
def scan_stop_times_csv(spark, sf_dir):
    path = fresh_dir(spark, "stop_times")
    columns = ["stop_id", F.lit("x").alias("stop_headsign"), "trip_id", "departure_time"]
    view(spark, sf_dir, "stop_times").select(*columns).write.option("header", True).csv(path)
    return static.read_stop_times_csv(spark, path)


def _bundles(spark, sf_dir) -> str:
    base = fresh_dir(spark, "bundles")
    fixtures.write_bundles(view(spark, sf_dir, "stop_times"), base)
    return base


@query("scan_static_zip", with_views("select trip_id, stop_id, departure_time from stop_times", "stop_times"))
def scan_static_zip(spark, sf_dir):
    return normalise.bundle_stop_times(spark, _bundles(spark, sf_dir)).drop("archive")


@query(
    "static_profile",
    with_views(
        """select 'stop_times' as "table", count(*) as "rows", 'departure_time,stop_id,trip_id' as columns, true as sampled from stop_times
        union all select 'stops', count(distinct stop_id), 'stop_id,stop_name', true from stop_times""",
        "stop_times",
    ),
)
def static_profile_query(spark, sf_dir):
    """All tables of the bundles. Bundles hold parts of one schedule and repeat stops: each counts once."""
    rows = static.good_rows(static.read_static_bundles(spark, _bundles(spark, sf_dir)))
    first = rows.where("table = 'stops'").groupBy(F.try_element_at("row", F.lit("stop_id")).alias("stop")).agg(
        F.min(F.struct("archive", "line_no")).alias("at")
    )
    s, f = rows.alias("s"), first.alias("f")
    once = (F.col("s.archive") == F.col("f.at.archive")) & (F.col("s.line_no") == F.col("f.at.line_no"))
    stops = s.where("s.table = 'stops'").join(f, once & (F.try_element_at("s.row", F.lit("stop_id")) == F.col("f.stop"))).select("s.*")
    profile = static_profile(rows.where("table <> 'stops'").unionByName(stops))
    return profile.select("table", "rows", F.array_join("columns", ",").alias("columns"), F.col("sample").isNotNull().alias("sampled"))


def _schedule_rows(spark, sf_dir):
    stop_times = view(spark, sf_dir, "stop_times")
    row = F.create_map(*[c for name in stop_times.columns for c in (F.lit(name), F.col(name))])
    return stop_times.select(
        F.concat(F.lit("feed_"), "stop_id").alias("label"),
        F.lit("20240131_000000").alias("stamp"),
        F.lit("stop_times").alias("table"),
        F.element_at(F.split("trip_id", "_"), -1).cast("bigint").alias("line_no"),
        row.alias("row"),
    )


def _static_json(spark, sf_dir) -> str:
    base = fresh_dir(spark, "static_json")
    documents.write_documents(documents.static_documents(_schedule_rows(spark, sf_dir)), base)
    return base


@query(
    "static_json_write",
    with_views(
        """select concat('feed_', stop_id) as feed_name, '20240131_000000' as stamp, 'stop_times' as "table", count(*) as n from stop_times group by 1""",
        "stop_times",
    ),
)
def static_json_write(spark, sf_dir):
    rows = static.read_static_json(spark, _static_json(spark, sf_dir))
    return rows.groupBy("feed_name", "stamp", "table").agg(F.count("*").alias("n"))


@query(
    "read_static_json",
    with_views("select concat('feed_', stop_id) as feed_name, trip_id, stop_id, departure_time from stop_times", "stop_times"),
)
def read_static_json(spark, sf_dir):
    rows = static.read_static_json(spark, _static_json(spark, sf_dir))
    return rows.select("feed_name", *[F.try_element_at("row", F.lit(c)).alias(c) for c in ("trip_id", "stop_id", "departure_time")])


# --- protobuf ------------------------------------------------------------------------------


def _payload_files(spark, sf_dir, feed_type: str):
    base = fresh_dir(spark, "payloads")
    write_named_files(fixtures.payloads(spark, sf_dir, feed_type), base)
    return read_payloads(spark, base, "*.pb")


@query(
    "decode_pb_trip_updates",
    with_views(
        """select concat('gtfs_rt_trip_updates_', agency, '_', strftime(date_trunc('day', snapshot_ts_jst), '%Y%m%d_%H%M%S'), '.pb') as file,
        cast(epoch(date_trunc('day', snapshot_ts_jst)) as bigint) - 32400 as header_time,
        trip_id, route_id, 0 as direction_id, '' as start_time, '' as start_date, vehicle_id,
        cast(floor(epoch(snapshot_ts_jst)) as bigint) - 32400 as tu_timestamp, delay from tu""",
        "tu",
    ),
)
def decode_pb_trip_updates(spark, sf_dir):
    decoded = protobuf.decode_trip_updates(_payload_files(spark, sf_dir, "trip_updates"))
    items = decoded.select(
        F.element_at(F.split("path", "/"), -1).alias("file"), F.col("timestamp").alias("header_time"), F.explode("trip_updates").alias("it")
    )
    return items.select("file", "header_time", "it.*").withColumnRenamed("timestamp", "tu_timestamp")


@query(
    "decode_pb_vehicle_positions",
    with_views(
        """select concat('gtfs_rt_vehicle_positions_', agency, '_', strftime(date_trunc('day', snapshot_ts_jst), '%Y%m%d_%H%M%S'), '.pb') as file,
        cast(epoch(date_trunc('day', snapshot_ts_jst)) as bigint) - 32400 as header_time, cast(floor(epoch(snapshot_ts_jst)) as bigint) - 32400 as vp_timestamp,
        vehicle_id, trip_id, route_id, 0 as direction_id, 0 as current_stop_sequence, 2 as current_status,
        lat is not null as located, round(cast(cast(lat as float) as double), 4) as lat, round(cast(cast(lon as float) as double), 4) as lon,
        case when lat is not null then cast(0 as double) end as bearing,
        case when lat is not null then round(cast(cast(speed as float) as double), 4) end as speed from vp""",
        "vp",
    ),
)
def decode_pb_vehicle_positions(spark, sf_dir):
    decoded = protobuf.decode_vehicle_positions(_payload_files(spark, sf_dir, "vehicle_positions"))
    file = F.element_at(F.split("path", "/"), -1).alias("file")
    items = decoded.select(file, F.col("timestamp").alias("header_time"), F.explode("vehicle_positions").alias("it"))
    flat = items.select(
        "file",
        "header_time",
        F.col("it.timestamp").alias("vp_timestamp"),
        *[f"it.{c}" for c in ("vehicle_id", "trip_id", "route_id", "direction_id", "current_stop_sequence", "current_status")],
        F.col("it.position").isNotNull().alias("located"),
        F.col("it.position.latitude").alias("lat"),
        F.col("it.position.longitude").alias("lon"),
        F.col("it.position.bearing").alias("bearing"),
        F.col("it.position.speed").alias("speed"),
    )
    return rounded(flat, "lat", "lon", "speed", digits=4)


@query(
    "pb_to_bronze",
    with_views(
        _tu_sql("day")
        .replace("cast(null as int) as direction_id, cast(null as varchar) as start_time", "0 as direction_id, '' as start_time")
        .replace("cast(null as varchar) as start_date", "'' as start_date"),
        "tu",
    ),
)
def pb_to_bronze(spark, sf_dir):
    """Payload files of trip updates to bronze, all columns."""
    base, table = fresh_dir(spark, "payloads"), fresh_dir(spark, "bronze")
    write_named_files(fixtures.payloads(spark, sf_dir, "trip_updates"), base)
    normalise.payloads_to_bronze(spark, base, table, "trip_updates")
    return bronze.read_bronze(spark, table, "trip_updates")


@query(
    "pb_positions_to_bronze",
    with_views(
        """select snapshot_filename, snapshot_ts_jst, date_str_jst, agency, entity_id, vehicle_id, trip_id, route_id, 0 as direction_id, '' as start_time,
        '' as start_date, 0 as current_stop_sequence, 2 as current_status, vp_timestamp,
        round(cast(cast(lat as float) as double), 4) as lat, round(cast(cast(lon as float) as double), 4) as lon,
        case when lat is not null then cast(0 as double) end as bearing, round(cast(cast(speed as float) as double), 4) as speed from ("""
        + _vp_sql("day")
        + ")",
        "vp",
    ),
)
def pb_positions_to_bronze(spark, sf_dir):
    base, table = fresh_dir(spark, "payloads"), fresh_dir(spark, "bronze")
    write_named_files(fixtures.payloads(spark, sf_dir, "vehicle_positions"), base)
    normalise.payloads_to_bronze(spark, base, table, "vehicle_positions")
    return rounded(bronze.read_bronze(spark, table, "vehicle_positions"), "lat", "lon", "speed", digits=4)


@query(
    "archive_agencies",
    with_views(
        f"""select agency, count(*) as trip_updates, cast(0 as bigint) as vehicle_positions, count(*) as documents,
        count(*) as processed, cast(0 as bigint) as skipped, cast(sum(bytes) as bigint) as bytes
        from ({_bytes_sql("trip_updates", "day")}) group by rollup(agency)""",
        "tu",
    ),
)
def archive_agencies(spark, sf_dir):
    base = _archives(spark, sf_dir, "trip_updates", packed=True)
    return normalise.archive_agencies(spark, base)


@query(
    "raw_archive",
    with_views(
        """select concat('gtfs_rt_trip_updates_', agency, '_', strftime(d, '%Y%m%d_%H%M%S'), '.pb') as name, n as entities, true as intact
        from (select agency, date_trunc('day', snapshot_ts_jst) as d, count(*) as n from tu group by 1, 2)""",
        "tu",
    ),
)
def raw_archive(spark, sf_dir):
    path = fresh_dir(spark, "raw_archive")
    payloads = _payload_files(spark, sf_dir, "trip_updates")
    file = F.element_at(F.split("path", "/"), -1)
    pattern = r"^gtfs_rt_trip_updates_(.+)_(\d{8}_\d{6})\.pb$"
    label, stamp = F.regexp_extract(file, pattern, 1), F.regexp_extract(file, pattern, 2)
    documents.archive_payloads(payloads, path, "trip_updates", label, stamp)
    kept = bronze.read_table(spark, path)
    sizes = kept.select("name", "path", (F.octet_length("content") == F.col("length")).alias("whole"))
    counted = protobuf.decode_trip_updates(kept).select("path", F.size("trip_updates").alias("n"))
    return sizes.join(counted, "path").groupBy("name").agg(
        F.sum("n").cast("bigint").alias("entities"), F.min("whole").alias("intact")
    )


# --- streams -------------------------------------------------------------------------------


@query("stream_bronze", with_views(_vp_sql("day"), "vp"))
def stream_bronze_query(spark, sf_dir):
    """Two drains: what had landed first, then a later agency; nothing is read twice."""
    base, table, checkpoint = (fresh_dir(spark, label) for label in ("landing", "bronze", "offsets"))
    docs = fixtures.flat_documents(fixtures.cycle_rows(spark, sf_dir, "vehicle_positions"), "vehicle_positions")
    for part in ("label = 'harbour_tram'", "label <> 'harbour_tram'"):
        documents.write_documents(docs.where(part), base)
        ingest_once(spark, base, table, checkpoint, "vehicle_positions")
    return _round_vp(bronze.read_bronze(spark, table, "vehicle_positions"))


@query("stream_dated_landing", with_views(_vp_sql("day"), "vp"))
def stream_dated_landing(spark, sf_dir):
    """A landing folder per date, drained in two rounds; dates that are done are not listed again."""
    base, table, checkpoint = (fresh_dir(spark, label) for label in ("landing", "bronze", "offsets"))
    docs = fixtures.flat_documents(fixtures.cycle_rows(spark, sf_dir, "vehicle_positions"), "vehicle_positions")
    dated = docs.withColumn("name", F.concat_ws("/", F.substring("stamp", 1, 8), "name"))
    middle = docs.agg(F.percentile_approx(F.substring("stamp", 1, 8).cast("int"), 0.5).cast("string")).first()[0]
    for part in (F.substring("stamp", 1, 8) <= middle, F.substring("stamp", 1, 8) > middle):
        documents.write_documents(dated.where(part), base)
        ingest_once(spark, base, table, checkpoint, "vehicle_positions", dated=True)
    return _round_vp(bronze.read_bronze(spark, table, "vehicle_positions"))


@query("bronze_compact", with_views(_vp_sql("day"), "vp"))
def bronze_compact(spark, sf_dir):
    """Streamed batches of two drains rewritten in the batch layout, then again for what came later."""
    live, closed, base, offsets = (fresh_dir(spark, label) for label in ("live", "closed", "landing", "offsets"))
    docs = fixtures.flat_documents(fixtures.cycle_rows(spark, sf_dir, "vehicle_positions"), "vehicle_positions")
    for since_batch, part in ((-1, "label = 'harbour_tram'"), (0, "label <> 'harbour_tram'")):
        documents.write_documents(docs.where(part), base)
        ingest_once(spark, base, live, offsets, "vehicle_positions")
        bronze.compact_bronze(spark, live, closed, "vehicle_positions", "99991231", since_batch)
    return _round_vp(bronze.read_bronze(spark, closed, "vehicle_positions"))


@query(
    "stream_once",
    with_views(
        "select 'trip_updates' as feed_type, agency, count(*) as n from tu group by 2 union all select 'vehicle_positions', agency, count(*) from vp group by 2",
        "tu",
        "vp",
    ),
)
def stream_once(spark, sf_dir):
    base = fixtures.landing(spark, sf_dir, "trip_updates", "vehicle_positions")
    table, checkpoint = fresh_dir(spark, "bronze"), fresh_dir(spark, "offsets")
    ingest_once(spark, base, table, checkpoint, "both")
    counts = [
        bronze.read_bronze(spark, table, f).groupBy(F.lit(f).alias("feed_type"), "agency").agg(F.count("*").alias("n"))
        for f in ("trip_updates", "vehicle_positions")
    ]
    return counts[0].unionByName(counts[1])


@query(
    "stream_with_static",
    with_views(
        """select 'trip_updates' as kind, count(*) as n from tu union all select 'vehicle_positions', count(*) from vp
        union all select 'departures', count(*) from stop_times""",
        "tu",
        "vp",
        "stop_times",
    ),
)
def stream_with_static_query(spark, sf_dir):
    base, bundles = fixtures.landing(spark, sf_dir, "trip_updates", "vehicle_positions"), _bundles(spark, sf_dir)
    table, schedule, checkpoint = (fresh_dir(spark, label) for label in ("bronze", "schedule", "offsets"))
    refresh = lambda: normalise.refresh_static_tables(spark, bundles, schedule)
    running = stream_with_static(spark, base, table, checkpoint, refresh, selection="both", once=True, files_per_batch=40)
    for stream in running:
        stream.awaitTermination()
    departures = normalise.read_static_tables(spark, schedule).where("table = 'stop_times'")
    counts = departures.agg(F.lit("departures").alias("kind"), F.count("*").alias("n"))
    for feed_type in ("trip_updates", "vehicle_positions"):
        rows = bronze.read_bronze(spark, table, feed_type)
        counts = counts.unionByName(rows.agg(F.lit(feed_type).alias("kind"), F.count("*").alias("n")))
    return counts


@query(
    "stream_minute_counts",
    with_views(
        "select agency, date_trunc('minute', snapshot_ts_jst) as minute, count(*) as n from vp group by 1, 2",
        "vp",
    ),
)
def stream_minute_counts_query(spark, sf_dir):
    output, checkpoint = fresh_dir(spark, "minutes"), fresh_dir(spark, "offsets")
    stream = (
        spark.readStream.schema(events(spark, sf_dir).schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )
    agency = F.when(F.col("event_id") % 2 == 0, "harbour_tram").otherwise("harbour_bus")
    rows = stream.select(F.col("ts").alias("snapshot_ts_jst"), agency.alias("agency"))
    stream_minute_counts(rows, output, checkpoint, once=True).awaitTermination()
    return read_minute_counts(spark, output)
