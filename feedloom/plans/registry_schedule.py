"""Registered queries: schedules, headways, scalar functions, filters and exploration."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from feedloom.functions import clock, names
from feedloom.operators import activity, filters, headway, ranking, reports
from feedloom.operators.documents import document_time, infer_agency
from feedloom.plans.fixtures import cycle_rows, documents
from feedloom.plans.normalise import map_table
from feedloom.plans.views import view, with_views
from feedloom.sources.snapshots import documents_from_members, documents_from_names

QUERIES, ORACLES = {}, {}


def query(key: str, sql: str | None = None):
    def register(function):
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register


def rounded(df, *columns, digits: int = 6):
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


# --- headway -------------------------------------------------------------------------------

_DEPARTURES = """, d as (
  select trip_id, stop_id, departure_time,
    cast(substr(departure_time, 1, 2) as bigint) * 3600 + cast(substr(departure_time, 4, 2) as bigint) * 60
      + cast(substr(departure_time, 7, 2) as bigint) as departure_time_seconds,
    nullif(regexp_extract(trip_id, '^[^_]+_[^_]+_([^_]+)', 1), '') as route_id_extracted
  from stop_times)"""
_HEADWAYS = _DEPARTURES + """, h as (
  select *, departure_time_seconds - lag(departure_time_seconds) over (
      partition by route_id_extracted, stop_id order by departure_time_seconds, trip_id) as headway_s
  from d)"""
_STATS = _HEADWAYS + """, st as (
  select route_id_extracted, stop_id, avg(headway_s) as mean_headway_s, median(headway_s) as median_headway_s,
    stddev_samp(headway_s) as std_headway_s, stddev_samp(headway_s) / nullif(avg(headway_s), 0) as cv_headway
  from h group by 1, 2)"""


def _with(extra: str, body: str, *view_names: str) -> str:
    return with_views("--", *view_names).replace("\n--", extra + "\n" + body)


@query(
    "headway_stats",
    _with(
        _STATS,
        """select route_id_extracted, stop_id, round(mean_headway_s, 6) as mean_headway_s,
        round(median_headway_s, 6) as median_headway_s, round(std_headway_s, 6) as std_headway_s,
        round(cv_headway, 6) as cv_headway from st""",
        "stop_times",
    ),
)
def headway_stats(spark, sf_dir):
    stats = headway.headway_stats(view(spark, sf_dir, "stop_times"))
    return rounded(stats, "mean_headway_s", "median_headway_s", "std_headway_s", "cv_headway")


@query(
    "headway_by_route",
    _with(
        _STATS,
        """select route_id_extracted, round(avg(mean_headway_s), 6) as mean_headway_s from st
        where route_id_extracted is not null group by 1""",
        "stop_times",
    ),
)
def headway_by_route(spark, sf_dir):
    return rounded(headway.headway_by_route(headway.headway_stats(view(spark, sf_dir, "stop_times"))), "mean_headway_s")


@query("headway", _with(_HEADWAYS, "select * from h", "stop_times"))
def headway_rows(spark, sf_dir):
    return headway.headway(view(spark, sf_dir, "stop_times"))


@query("sort_departures", _with(_DEPARTURES, "select * from d order by route_id_extracted, stop_id, departure_time_seconds", "stop_times"))
def sort_departures(spark, sf_dir):
    return headway.sort_departures(view(spark, sf_dir, "stop_times"))


@query("departure_seconds", _with(_DEPARTURES, "select trip_id, departure_time_seconds from d", "stop_times"))
def departure_seconds(spark, sf_dir):
    return view(spark, sf_dir, "stop_times").select(
        "trip_id", clock.clock_seconds(F.col("departure_time")).alias("departure_time_seconds")
    )


@query("route_token", _with(_DEPARTURES, "select trip_id, route_id_extracted as route from d", "stop_times"))
def route_token(spark, sf_dir):
    return view(spark, sf_dir, "stop_times").select("trip_id", names.route_token(F.col("trip_id")).alias("route"))


# --- names and times -----------------------------------------------------------------------

# Event rows dressed as snapshot files: with and without agency, and names to reject.
_NAMES = """, nm as (
  select event_id, concat(case when event_id % 7 = 0 then 'other_' else 'gtfs_rt_' end,
      case when event_id % 2 = 0 then 'trip_updates_' else 'vehicle_positions_' end,
      case when event_id % 3 = 0 then '' else concat(agency, '_') end,
      date_str_jst, '_', case when event_id % 11 = 0 then '99' else '12' end, lpad(cast(event_id % 60 as string), 2, '0'), '05.json') as name
  from (select event_id, agency, concat(cast(year(ts) as string), lpad(cast(month(ts) as string), 2, '0'),
      lpad(cast(day(ts) as string), 2, '0')) as date_str_jst from base) x)"""
_NAME_PARTS = _NAMES + """, np as (
  select event_id, name, nullif(regexp_extract(name, '^gtfs_rt_(trip_updates|vehicle_positions)_', 1), '') as feed_type,
    regexp_extract(name, '_(\\d{8}_\\d{6})\\.json$', 1) as stamp,
    nullif(regexp_extract(name, '^gtfs_rt_(?:trip_updates|vehicle_positions)_(.+?)_\\d{8}_\\d{6}\\.json$', 1), '') as agency
  from nm), ok as (select event_id, name, feed_type, coalesce(agency, 'unknown') as agency, stamp,
    try_strptime(stamp, '%Y%m%d_%H%M%S') as snapshot_ts_jst from np where feed_type is not null)"""


def _named_rows(spark, sf_dir):
    base = view(spark, sf_dir, "base")
    return spark.sql("with nm0 as (select 1)" + _NAMES.replace("from base", "from {base}") + " select * from nm", base=base)


@query(
    "fn_filename_parts",
    _with(
        _NAME_PARTS,
        """select event_id, agency, feed_type, snapshot_ts_jst, substr(stamp, 1, 8) as date_str_jst
        from ok where snapshot_ts_jst is not null""",
    ),
)
def fn_filename_parts(spark, sf_dir):
    parts = _named_rows(spark, sf_dir).select("event_id", names.filename_parts(F.col("name")).alias("p"))
    return parts.where("p is not null").select("event_id", "p.*")


@query(
    "snapshot_metadata",
    _with(
        _NAME_PARTS,
        """select agency, feed_type, substr(stamp, 1, 8) as date_str_jst, count(*) as files,
        min(snapshot_ts_jst) as first_ts, max(snapshot_ts_jst) as last_ts
        from ok where snapshot_ts_jst is not null group by 1, 2, 3""",
    ),
)
def snapshot_metadata(spark, sf_dir):
    parts = _named_rows(spark, sf_dir).select(names.filename_parts(F.col("name")).alias("p")).where("p is not null")
    return parts.groupBy("p.agency", "p.feed_type", "p.date_str_jst").agg(
        F.count("*").alias("files"), F.min("p.snapshot_ts_jst").alias("first_ts"), F.max("p.snapshot_ts_jst").alias("last_ts")
    )


@query(
    "fn_jst_instant",
    with_views("select event_id, cast(floor(epoch(snapshot_ts_jst)) as bigint) - 32400 as epoch_s from vp", "vp"),
)
def fn_jst_instant(spark, sf_dir):
    return view(spark, sf_dir, "vp").select(
        "event_id", F.unix_seconds(clock.jst_instant(F.col("snapshot_ts_jst"))).alias("epoch_s")
    )


@query("fn_date_str", with_views("select event_id, strftime(snapshot_ts_jst, '%Y%m%d') as d from vp", "vp"))
def fn_date_str(spark, sf_dir):
    return view(spark, sf_dir, "vp").select("event_id", clock.date_str(F.col("snapshot_ts_jst")).alias("d"))


@query("fn_epoch_ms", with_views("select event_id, epoch_us(snapshot_ts_jst) // 1000 as ms from vp", "vp"))
def fn_epoch_ms(spark, sf_dir):
    return view(spark, sf_dir, "vp").select("event_id", clock.epoch_ms(F.col("snapshot_ts_jst")).alias("ms"))


@query("fn_ts_text", with_views("select event_id, strftime(snapshot_ts_jst, '%Y-%m-%d %H:%M:%S') as t from vp", "vp"))
def fn_ts_text(spark, sf_dir):
    return view(spark, sf_dir, "vp").select("event_id", clock.ts_text(F.col("snapshot_ts_jst")).alias("t"))


@query(
    "fn_agency_from_vehicle",
    with_views(
        """select event_id, array_to_string(string_split(replace(replace(vehicle_id, '-', '_'), '.', '_'), '_')[1:2], '_') as agency
        from tu""",
        "tu",
    ),
)
def fn_agency_from_vehicle(spark, sf_dir):
    return view(spark, sf_dir, "tu").select("event_id", names.agency_from_vehicle(F.col("vehicle_id")).alias("agency"))


@query(
    "fn_first_nonempty",
    with_views(
        """select event_id, case when event_id % 3 = 0 then concat('nested-', trip_id) else vehicle_id end as id from tu""", "tu"
    ),
)
def fn_first_nonempty(spark, sf_dir):
    own = F.when(F.col("event_id") % 3 == 0, F.when(F.col("event_id") % 2 == 0, F.lit(""))).otherwise(F.col("vehicle_id"))
    nested = F.concat(F.lit("nested-"), F.col("trip_id"))
    return view(spark, sf_dir, "tu").select("event_id", names.first_nonempty(own, nested).alias("id"))


@query(
    "fn_feed_label",
    """with p as (select page_id, regexp_extract(url, '^(?:[^:/?#]+:)?(?://([^/?#]*))?([^?#]*)', 1) as host,
      regexp_replace(regexp_extract(url, '^(?:[^:/?#]+:)?(?://([^/?#]*))?([^?#]*)', 2), ';[^/]*$', '') as path from pages),
    l as (select page_id, host, regexp_extract(path, '([^/]+)/*$', 1) as leaf from p)
    select page_id, coalesce(nullif(replace(replace(coalesce(nullif(regexp_extract(leaf, '^(.+)\\.[^.]+$', 1), ''),
      nullif(leaf, ''), nullif(host, '')), '.', '_'), '-', '_'), ''), 'gtfs_static') as label from l""",
)
def fn_feed_label(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", names.feed_label(F.col("url")).alias("label"))


@query(
    "fn_artifact_name",
    with_views(
        """select event_id, case event_id % 4
          when 0 then concat('gtfs_rt_trip_updates_', agency, '_', strftime(ts, '%Y%m%d_%H%M%S'), '.json')
          when 1 then concat('gtfs_rt_trip_updates_trip_updates_', strftime(ts, '%Y%m%d_%H%M%S'), '.pb')
          when 2 then concat('gtfs_static_', agency, '_', strftime(ts, '%Y%m%d_%H%M%S'), '.json')
          else concat('gtfs_static_', strftime(ts, '%Y%m%d_%H%M%S'), '.zip') end as name from base"""
    ),
)
def fn_artifact_name(spark, sf_dir):
    kind = F.element_at(F.array(*map(F.lit, ("rt_json", "rt_raw", "static_json", "static_raw"))), (F.col("event_id") % 4 + 1).cast("int"))
    label = F.when(F.col("event_id") % 2 == 0, F.col("agency"))
    return view(spark, sf_dir, "base").select(
        "event_id", names.artifact_name(kind, F.lit("trip_updates"), label, clock.ts_to_stamp(F.col("ts"))).alias("name")
    )


# --- what documents say about themselves ---------------------------------------------------


def _members(spark, sf_dir):
    """Trip-update documents per agency and hour, as archive members."""
    docs = documents(spark, sf_dir, "trip_updates", "hour")
    return docs.select(F.col("name").alias("member"), "feed_type", "content")


_HOURLY = """select distinct agency, date_trunc('hour', snapshot_ts_jst) as hr from tu"""


@query(
    "fn_document_time",
    with_views(f"select cast(hr as timestamp) as snapshot_ts_jst, count(*) as n from ({_HOURLY}) group by 1", "tu"),
)
def fn_document_time(spark, sf_dir):
    docs = documents_from_members(_members(spark, sf_dir))
    times = docs.select(document_time(F.col("doc"), F.col("feed_type")).alias("snapshot_ts_jst"), "snapshot_filename")
    return times.distinct().groupBy("snapshot_ts_jst").agg(F.count("*").alias("n"))


@query(
    "fn_document_agency",
    with_views(
        f"""select case when agency = 'harbour_tram' then agency end as agency, count(*) as n from ({_HOURLY}) group by 1""", "tu"
    ),
)
def fn_document_agency(spark, sf_dir):
    docs = documents_from_members(_members(spark, sf_dir))
    agency = names.agency_from_feed_name(F.col("doc.feed_name"))
    return docs.select(agency.alias("agency"), "snapshot_ts_jst").distinct().groupBy("agency").agg(F.count("*").alias("n"))


@query(
    "canonical_name",
    with_views(
        f"""select concat('gtfs_rt_trip_updates_', case when agency = 'harbour_tram' then concat(agency, '_') else '' end,
        strftime(hr, '%Y%m%d_%H%M%S'), '.json') as name from ({_HOURLY})""",
        "tu",
    ),
)
def canonical_name(spark, sf_dir):
    docs = documents_from_members(_members(spark, sf_dir))
    return docs.select(F.col("snapshot_filename").alias("name")).distinct()


@query(
    "infer_agency",
    with_views(f"select agency, count(*) as documents from ({_HOURLY}) group by 1", "tu"),
)
def infer_agency_query(spark, sf_dir):
    docs = documents_from_members(_members(spark, sf_dir))
    inferred = docs.select(infer_agency(F.col("doc")).alias("agency"), "snapshot_ts_jst").distinct()
    return inferred.groupBy("agency").agg(F.count("*").alias("documents"))


@query(
    "classify_feed",
    with_views(
        """select case event_id % 3 when 0 then 'trip_updates' else 'vehicle_positions' end as feed_type, count(*) as n
        from base where event_id % 3 < 2 group by 1"""
    ),
)
def classify_feed(spark, sf_dir):
    kinds = F.array(*map(F.lit, ("x/trip_update_{}", "vehicle_positions/{}", "alerts/{}")))
    member = F.replace(
        F.element_at(kinds, (F.col("event_id") % 3 + 1).cast("int")), F.lit("{}"), F.concat(F.col("event_id").cast("string"), F.lit(".json"))
    )
    members = view(spark, sf_dir, "base").select(names.classify_feed(member).alias("feed_type"))
    return members.where("feed_type is not null").groupBy("feed_type").agg(F.count("*").alias("n"))


# --- filters -------------------------------------------------------------------------------

_VP_COLUMNS = "event_id, vehicle_id, agency, snapshot_ts_jst, round(lat, 6) as lat, round(lon, 6) as lon"


def _vp_rows(df):
    return rounded(df.select("event_id", "vehicle_id", "agency", "snapshot_ts_jst", "lat", "lon"), "lat", "lon")


@query(
    "project_map_points",
    with_views(
        """select round(lat, 6) as lat, round(lon, 6) as lon, snapshot_ts_jst, vehicle_id, route_id from vp
        where lat is not null and lon is not null""",
        "vp",
    ),
)
def project_map_points(spark, sf_dir):
    return rounded(filters.project_map_points(view(spark, sf_dir, "vp")), "lat", "lon")


@query(
    "map_table",
    with_views(
        """select round(lat, 6) as lat, round(lon, 6) as lon, snapshot_ts_jst, vehicle_id, route_id,
        epoch_us(snapshot_ts_jst) // 1000 as "timestamp", strftime(snapshot_ts_jst, '%Y-%m-%d %H:%M:%S') as snapshot_ts from vp
        where lat is not null and lon is not null""",
        "vp",
    ),
)
def map_table_query(spark, sf_dir):
    return rounded(map_table(view(spark, sf_dir, "vp")), "lat", "lon")


@query(
    "drop_null_positions",
    with_views(
        """select event_id, round(lat, 6) as latitude, round(lon, 6) as longitude from vp
        where lat is not null and lon is not null""",
        "vp",
    ),
)
def drop_null_positions(spark, sf_dir):
    kept = filters.drop_null_positions(view(spark, sf_dir, "vp")).select("event_id", "latitude", "longitude")
    return rounded(kept, "latitude", "longitude")


@query(
    "service_hours",
    with_views(
        f"""select {_VP_COLUMNS} from vp
        where hour(snapshot_ts_jst) > 5 or (hour(snapshot_ts_jst) = 5 and minute(snapshot_ts_jst) >= 30)""",
        "vp",
    ),
)
def service_hours(spark, sf_dir):
    return _vp_rows(filters.service_hours(view(spark, sf_dir, "vp"), "snapshot_ts_jst"))


@query("service_day", with_views(f"select {_VP_COLUMNS} from vp where cast(snapshot_ts_jst as date) = date '2024-01-10'", "vp"))
def service_day(spark, sf_dir):
    return _vp_rows(filters.service_day(view(spark, sf_dir, "vp"), "snapshot_ts_jst", date(2024, 1, 10)))


@query(
    "parse_or_drop_ts",
    with_views(
        """select event_id, date_trunc('second', snapshot_ts_jst) as t from vp where event_id % 5 <> 0""",
        "vp",
    ),
)
def parse_or_drop_ts(spark, sf_dir):
    iso = clock.ts_text(F.col("snapshot_ts_jst"))
    text = (
        F.when(F.col("event_id") % 5 == 0, F.lit("not a time"))
        .when(F.col("event_id") % 5 == 1, F.translate(iso, "-", "/"))
        .otherwise(iso)
    )
    texts = view(spark, sf_dir, "vp").select("event_id", text.alias("t"))
    return filters.parse_or_drop_ts(texts, "t", ["yyyy/MM/dd HH:mm:ss"])


@query("agency_filter_one", with_views(f"select {_VP_COLUMNS} from vp where agency = 'harbour_tram'", "vp"))
def agency_filter_one(spark, sf_dir):
    return _vp_rows(filters.agency_filter(view(spark, sf_dir, "vp"), "harbour_tram"))


@query(
    "agency_filter_list",
    with_views(
        """select vehicle_id as agency, count(*) as n from vp
        where vehicle_id in ('harbour_tram_2', 'harbour_bus_3', 'harbour_bus_5') group by 1""",
        "vp",
    ),
)
def agency_filter_list(spark, sf_dir):
    per_vehicle = view(spark, sf_dir, "vp").select(F.col("vehicle_id").alias("agency"))
    kept = filters.agency_filter(per_vehicle, "harbour_tram_2, harbour_bus_3,harbour_bus_5")
    return kept.groupBy("agency").agg(F.count("*").alias("n"))


def _both_feeds(spark, sf_dir):
    tu = view(spark, sf_dir, "tu").select("event_id", "agency", "snapshot_ts_jst", F.lit("trip_updates").alias("feed_type"))
    vp = view(spark, sf_dir, "vp").select("event_id", "agency", "snapshot_ts_jst", F.lit("vehicle_positions").alias("feed_type"))
    return tu.unionByName(vp)


@query("feed_filter", with_views("select event_id, agency, snapshot_ts_jst, 'trip_updates' as feed_type from tu", "tu"))
def feed_filter(spark, sf_dir):
    return filters.feed_filter(_both_feeds(spark, sf_dir), "trip_updates")


@query("quiet_hours", with_views(f"select {_VP_COLUMNS} from vp where hour(snapshot_ts_jst) >= 5", "vp"))
def quiet_hours(spark, sf_dir):
    return _vp_rows(filters.quiet_hours(view(spark, sf_dir, "vp"), "snapshot_ts_jst"))


@query(
    "empty_snapshot_schema",
    with_views(
        """select agency, count(*) as documents, cast(0 as bigint) as "rows", 13 as column_count
        from (select distinct agency, date_trunc('hour', snapshot_ts_jst) from tu) group by 1""",
        "tu",
    ),
)
def empty_snapshot_schema(spark, sf_dir):
    """Documents with an empty flat list yield no rows, and the table keeps its columns."""
    from feedloom.operators.flatten import document_row_count, flatten_trip_updates

    rows = cycle_rows(spark, sf_dir, "trip_updates", "hour")
    hollow = rows.select("label", "stamp").distinct().select(
        names.artifact_name(F.lit("rt_json"), F.lit("trip_updates"), F.col("label"), F.col("stamp")).alias("snapshot_filename"),
        F.lit('{"trip_updates": [], "entity": [{"id": "1", "trip_update": {"trip": {"trip_id": "t"}}}]}').alias("content"),
    )
    docs = documents_from_names(hollow)
    flat = flatten_trip_updates(docs)
    per_agency = docs.groupBy("agency").agg(
        F.count("*").alias("documents"), F.sum(document_row_count(F.col("feed_type"), F.col("doc"))).cast("bigint").alias("rows")
    )
    found = flat.groupBy("agency").agg(F.count("*").alias("exploded"))
    return per_agency.join(found, "agency", "left").select(
        "agency", "documents", (F.col("rows") + F.coalesce("exploded", F.lit(0))).alias("rows"), F.lit(len(flat.columns)).alias("column_count")
    )


# --- exploration ---------------------------------------------------------------------------


@query(
    "records_per_minute",
    with_views(
        """select m as minute, coalesce(n, 0) as n from
        (select unnest(generate_series(date_trunc('minute', min(snapshot_ts_jst)), date_trunc('minute', max(snapshot_ts_jst)), interval 1 minute)) as m from vp)
        left join (select date_trunc('minute', snapshot_ts_jst) as k, count(*) as n from vp group by 1) on m = k""",
        "vp",
    ),
)
def records_per_minute(spark, sf_dir):
    return activity.records_per_minute(view(spark, sf_dir, "vp"), "snapshot_ts_jst")


@query("distinct_vehicles", with_views("select distinct vehicle_id from vp", "vp"))
def distinct_vehicles(spark, sf_dir):
    return activity.distinct_values(view(spark, sf_dir, "vp"), "vehicle_id")


@query(
    "filter_counts",
    with_views(
        """select count(*) as total, count(lat) as located_kept, count(*) - count(lat) as located_dropped,
        count(*) filter (hour(snapshot_ts_jst) >= 5) as awake_kept, count(*) filter (hour(snapshot_ts_jst) < 5) as awake_dropped from vp""",
        "vp",
    ),
)
def filter_counts(spark, sf_dir):
    return activity.filter_counts(
        view(spark, sf_dir, "vp"), located=F.col("lat").isNotNull(), awake=F.hour("snapshot_ts_jst") >= 5
    )


@query(
    "downsample_positions",
    with_views(
        """select vehicle_id, time_bucket(interval '1 hour', snapshot_ts_jst) as snapshot_ts_jst,
        round(arg_min(lat, snapshot_ts_jst), 6) as latitude, round(arg_min(lon, snapshot_ts_jst), 6) as longitude,
        round(avg(speed), 6) as speed, count(*) as n from vp where lat is not null and lon is not null group by 1, 2""",
        "vp",
    ),
)
def downsample_positions(spark, sf_dir):
    coarse = activity.downsample_positions(view(spark, sf_dir, "vp"), "1 hour")
    return rounded(coarse, "latitude", "longitude", "speed")


@query(
    "first_positions",
    with_views(f"select {_VP_COLUMNS} from vp order by vp.snapshot_ts_jst, md5(cast(event_id as string)), event_id limit 1000", "vp"),
)
def first_positions(spark, sf_dir):
    return _vp_rows(ranking.first_n(view(spark, sf_dir, "vp"), "snapshot_ts_jst", "event_id", 1000))


@query("head_rows", with_views(f"select {_VP_COLUMNS} from vp order by vp.snapshot_ts_jst, event_id limit 100", "vp"))
def head_rows(spark, sf_dir):
    return _vp_rows(ranking.head_rows(view(spark, sf_dir, "vp"), 100, ["snapshot_ts_jst", "event_id"]))


@query(
    "slice_rows",
    with_views(
        f"select {_VP_COLUMNS} from vp order by vp.snapshot_ts_jst, md5(cast(event_id as string)), event_id limit 5 offset 7000", "vp"
    ),
)
def slice_rows(spark, sf_dir):
    return _vp_rows(ranking.slice_rows(view(spark, sf_dir, "vp"), "snapshot_ts_jst", "event_id", 7000, 7005))


@query(
    "sample_n",
    with_views(f"select {_VP_COLUMNS} from vp order by md5(concat('0:', cast(event_id as string))), event_id limit 2000", "vp"),
)
def sample_n(spark, sf_dir):
    return _vp_rows(ranking.sample_n(view(spark, sf_dir, "vp"), "event_id", 2000))


@query(
    "union_snapshots",
    with_views("select agency, count(*) as n from (select agency from vp union all select agency from vp union all select agency from tu) group by 1", "vp", "tu"),
)
def union_snapshots(spark, sf_dir):
    from feedloom.sources.bronze import union_snapshots as union

    both = _both_feeds(spark, sf_dir)
    again = both.where("feed_type = 'vehicle_positions'")
    return union(both, again).groupBy("agency").agg(F.count("*").alias("n"))


# --- cycles --------------------------------------------------------------------------------


@query(
    "cycle_success",
    with_views(
        """select date_trunc('hour', ts) as cycle_ts, count(*) filter (event_type <> 'error') as ok, count(*) as total from base group by 1"""
    ),
)
def cycle_success(spark, sf_dir):
    log = view(spark, sf_dir, "base").select(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("cycle_ts"), (F.col("event_type") != "error").alias("ok")
    )
    return reports.cycle_success(log)


@query(
    "cycle_completeness",
    with_views(
        """select date_trunc('hour', ts) as snapshot_ts_jst, cast(count(distinct event_type) as int) as feeds_present,
        5 as feeds_expected, count(distinct event_type) = 5 as complete from base group by 1"""
    ),
)
def cycle_completeness(spark, sf_dir):
    feeds = view(spark, sf_dir, "base").select(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("snapshot_ts_jst"), F.col("event_type").alias("feed")
    )
    return reports.cycle_completeness(feeds, ["view", "purchase", "signup", "click", "error"])


@query("retention_window", with_views(f"select {_VP_COLUMNS} from vp where date_str_jst >= '20240123'", "vp"))
def retention_window(spark, sf_dir):
    from feedloom.sources.bronze import retention_window as window

    return _vp_rows(window(view(spark, sf_dir, "vp"), 7, "20240130"))


