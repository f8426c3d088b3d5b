"""Transit-shaped views of the driver's ``events`` table.

The SQL texts run unchanged on Spark and on the checking engine, so a query and its check
start from the same rows. All of them cover the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "base": """
select *, user_id % 20 as u, case when event_id % 2 = 0 then 'harbour_tram' else 'harbour_bus' end as agency from events""",
    "stop_times": """
select concat('wd_', event_type, '_r', cast(u % 3 as string), '_', cast(event_id as string)) as trip_id,
       concat('s', cast(u % 5 as string)) as stop_id,
       concat(lpad(cast(hour(ts) + case when hour(ts) < 3 then 24 else 0 end as string), 2, '0'), ':',
              lpad(cast(minute(ts) as string), 2, '0'), ':',
              lpad(cast(cast(floor(second(ts)) as int) as string), 2, '0')) as departure_time
from base""",
    "vp": """
select event_id, concat(agency, '_', cast(u as string)) as vehicle_id, agency, ts as snapshot_ts_jst,
       concat(cast(year(ts) as string), lpad(cast(month(ts) as string), 2, '0'), lpad(cast(day(ts) as string), 2, '0')) as date_str_jst,
       concat('t', cast(event_id % 50 as string)) as trip_id, concat('r', cast(u % 3 as string)) as route_id,
       cast(event_id % 9 as int) as current_stop_sequence, cast(event_id % 3 as int) as current_status,
       case when event_type = 'error' then null else cast(36.4 as double) + (event_id % 700) / cast(1000 as double) end as lat,
       case when event_type = 'error' then null else cast(136.9 as double) + (event_id % 800) / cast(1000 as double) end as lon,
       value as speed
from base""",
    "tu": """
select event_id, concat('t', cast(event_id % 50 as string)) as trip_id, concat('r', cast(u % 3 as string)) as route_id, agency,
       ts as snapshot_ts_jst, concat(agency, '-', cast(u as string)) as vehicle_id,
       case when event_type = 'signup' then null else cast(event_id % 600 - 120 as int) end as delay
from base""",
    "transitions": """
select event_id as id, u as run, ts as ord, event_id % 7 as s, event_id % 4 as a, round(value) as r,
       case when event_type = 'error' then cast(1 as double) else cast(0 as double) end as c,
       (event_id * 3 + 1) % 7 as s2, event_type = 'purchase' as done, value as priority,
       cast(event_id % 5 as double) as q0, cast(event_id % 3 as double) as q1, cast(event_id % 4 as double) as q2, cast(event_id % 6 as double) as q3,
       event_id % 2 = 0 as m0, true as m1, event_id % 3 <> 0 as m2, event_id % 5 <> 0 as m3
from base""",
}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame; unused columns are pruned down to the scan."""
    base = spark.sql(VIEWS["base"].replace("from events", "from {events}"), events=events(spark, sf_dir))
    if name == "base":
        return base
    return spark.sql(VIEWS[name].replace("from base", "from {base}"), base=base)


def with_views(body: str, *names: str) -> str:
    """Oracle text: ``body`` over the named views as common table expressions."""
    ctes = ["base"] + [n for n in names if n != "base"]
    defs = ",\n".join(f"{n} as ({VIEWS[n].strip()})" for n in ctes)
    return f"with {defs}\n{body.strip()}"
