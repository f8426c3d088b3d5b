"""Versions of a table: whole or not at all, bounded folders, nothing lost when a step fails."""

import os
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from feedloom.plans import normalise
from feedloom.sources.bronze import append_bronze_batch, merge_bronze, read_bronze
from feedloom.sources.schemas import BRONZE
from feedloom.sources.versions import Entry, VersionLog, read_folders

SCHEMA = f"{BRONZE['trip_updates']}, feed_type STRING"


def rows(spark, n, trip, date="20251114"):
    names = [f.split()[0] for f in BRONZE["trip_updates"].replace("\n", " ").split(",")]
    given = {"agency": F.lit("a"), "date_str_jst": F.lit(date), "trip_id": F.concat(F.lit(f"{trip}-"), "id")}
    frame = spark.range(n)
    blank = spark.createDataFrame([], BRONZE["trip_updates"])
    return frame.select(*[given.get(c, F.lit(None)).cast(blank.schema[c].dataType).alias(c) for c in names])


def trips(spark, base):
    return sorted(r.trip_id for r in read_bronze(spark, base, "trip_updates").collect())


class Crash(Exception):
    pass


def test_a_write_that_breaks_off_leaves_no_trace(spark, tmp_path):
    base = str(tmp_path / "live")
    append_bronze_batch(rows(spark, 2, "x"), base, "trip_updates", 0)
    log = VersionLog(spark, base, "trip_updates")

    def broken(path):
        rows(spark, 5, "lost").write.parquet(path)
        raise Crash

    with pytest.raises(Crash):  # after the rows, before the version
        log.put_batch(1, broken)
    (tmp_path / "live/_log/trip_updates/.1-leftover").write_text("{")  # before the rename
    assert trips(spark, base) == ["x-0", "x-1"]
    append_bronze_batch(rows(spark, 1, "y"), base, "trip_updates", 1)
    append_bronze_batch(rows(spark, 1, "z"), base, "trip_updates", 1)  # the batch again
    assert trips(spark, base) == ["x-0", "x-1", "z-0"]
    assert len(list((tmp_path / "live/data/trip_updates").iterdir())) == 4
    assert len(log.vacuum(0)) == 2 and trips(spark, base) == ["x-0", "x-1", "z-0"]


def test_folders_stay_few_and_merged_batches_are_not_added_again(spark, tmp_path):
    base, data = str(tmp_path / "live"), tmp_path / "live/data/trip_updates"
    for batch in range(11):
        append_bronze_batch(rows(spark, 1, f"b{batch}"), base, "trip_updates", batch)
        merge_bronze(spark, base, "trip_updates", fan=3, keep_days=0)
        assert len(list(data.iterdir())) <= 6
    want = sorted(f"b{i}-0" for i in range(11))
    assert trips(spark, base) == want
    append_bronze_batch(rows(spark, 1, "again"), base, "trip_updates", 4)
    assert trips(spark, base) == want
    dates = [p for p in Path(base).rglob("date_str_jst=20251114") if p.is_dir()]
    assert len(dates) <= 6


def test_a_merge_gives_way_to_a_batch_stored_meanwhile(spark, tmp_path):
    base = str(tmp_path / "live")
    for batch in range(3):
        append_bronze_batch(rows(spark, 1, f"b{batch}"), base, "trip_updates", batch)
    log, asked = VersionLog(spark, base, "trip_updates"), []

    def rewrite(folders, path):
        read_folders(spark, folders, SCHEMA).write.partitionBy("agency", "feed_type", "date_str_jst").parquet(path)
        if not asked:
            asked.append(1)
            append_bronze_batch(rows(spark, 1, "new"), base, "trip_updates", 1)

    assert log.merge(rewrite, fan=3) == 1  # the first attempt is void, the second has the new rows
    assert trips(spark, base) == ["b0-0", "b2-0", "new-0"]


def test_two_writers_never_share_a_version(spark, tmp_path):
    one, two = (VersionLog(spark, str(tmp_path), "t") for _ in range(2))
    tries = []

    def slow(entries):
        tries.append(1)
        if len(tries) == 1:
            two.commit(lambda now: (*now, Entry("two")))
        return (*entries, Entry("one"))

    assert one.commit(slow) and len(tries) == 2
    assert [e.folder for e in one.current().entries] == ["two", "one"] and one.current().number == 1


def test_vacuum_keeps_what_is_young_or_named(spark, tmp_path):
    log = VersionLog(spark, str(tmp_path), "t")
    for i in range(3):
        folder = log.fresh()
        spark.range(1).write.parquet(f"{tmp_path}/{folder}")
        log.commit(lambda entries, f=folder: (Entry(f),))
    assert log.vacuum(1) == []
    first = log._read(0).entries[0].folder
    path = tmp_path / f"_log/t/{1:020d}.json"  # the second version came long ago
    path.write_text(path.read_text().replace('"written": ', '"written": 0.0, "_": '))
    path.with_name(f".{path.name}.crc").unlink()
    os.utime(tmp_path / first, (0, 0))
    assert log.vacuum(1) == [first] and not (tmp_path / first).exists()
    assert len(log._numbers()) == 2 and spark.read.parquet(*log.folders()).count() == 1


def test_schedules_are_read_again_only_when_bundles_change(spark, tmp_path):
    bundles, base = tmp_path / "bundles", str(tmp_path / "schedule")
    bundles.mkdir()

    def bundle(name, n):
        with zipfile.ZipFile(bundles / name, "w") as z:
            z.writestr("stop_times.txt", "trip_id,stop_id,departure_time\n" + "".join(f"t{i},s,10:00:00\n" for i in range(n)))

    bundle("one.zip", 5)
    assert normalise.refresh_static_tables(spark, str(bundles), base)
    assert not normalise.refresh_static_tables(spark, str(bundles), base)
    bundle("two.zip", 7)
    assert normalise.refresh_static_tables(spark, str(bundles), base, keep_days=0)
    assert normalise.read_static_tables(spark, base).count() == 12
    assert len(list((tmp_path / "schedule/data/schedule").iterdir())) == 1


def test_minute_counts_are_merged_in_place(spark, tmp_path):
    from feedloom.streaming.counts import merge_minute_counts, read_minute_counts, stream_minute_counts

    source, out = tmp_path / "in", str(tmp_path / "out")
    schema = "agency STRING, snapshot_ts_jst TIMESTAMP_NTZ"
    for i in range(4):
        spark.sql(f"select 'a' as agency, timestamp_ntz'2025-11-14 00:00:0{i}' as snapshot_ts_jst").write.mode("append").parquet(str(source))
        stream_minute_counts(spark.readStream.schema(schema).parquet(str(source)), out, str(tmp_path / "offsets"), once=True).awaitTermination()
    assert len(merge_minute_counts(spark, out, fan=2, keep_days=0)) == 4
    assert [r.n for r in read_minute_counts(spark, out).collect()] == [4]
    assert len(list((tmp_path / "out/data/minutes").iterdir())) == 1


def test_live_tables_are_merged_by_command_line(spark, tmp_path):
    from feedloom import cli

    live, closed = str(tmp_path / "live"), str(tmp_path / "closed")
    for batch in range(10):
        append_bronze_batch(rows(spark, 1, f"b{batch}"), live, "trip_updates", batch)
    cli.main(["compact", "--live-dir", live, "--feed-type", "trip_updates", "--keep-days", "0"])
    assert len(list((tmp_path / "live/data/trip_updates").iterdir())) == 1 and len(trips(spark, live)) == 10
    cli.main(["compact", "--live-dir", live, "--feed-type", "trip_updates", "--closed-dir", closed, "--before", "20251115"])
    assert trips(spark, closed) == trips(spark, live)
