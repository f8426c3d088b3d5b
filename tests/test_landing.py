"""Dated landing folders: every file once, late moves within a date, closed dates left alone."""

import json
import os
import random

from feedloom.sources import landing
from feedloom.sources.bronze import read_bronze
from feedloom.sources.landing import DatedFolders
from feedloom.streaming.ingest import ingest_once


def put(base, day, name, at, text="{}"):
    folder = base / day
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"gtfs_rt_trip_updates_{name}.json"
    path.write_text(text)
    os.utime(path, (at, at))


def reader(base, **options):
    return DatedFolders({"path": str(base), "pattern": "gtfs_rt_trip_updates_*.json", **options})


def names(rows):
    return sorted(path.rsplit("_", 1)[1].removesuffix(".json") for path, _ in rows)


def test_every_file_once_in_any_order(tmp_path):
    rng = random.Random(2)
    source, offset, got, put_names = reader(tmp_path, maxFiles=3, lateness=50, graceDays=2), None, [], []
    offset = source.initialOffset()
    for i in range(60):
        day = f"202511{10 + i // 20}"
        put(tmp_path, day, f"n{i}", 1000 + i * 10 - rng.randrange(50))  # up to lateness out of order
        put_names.append(f"n{i}")
        if rng.random() < 0.5:
            rows, end = source.read(offset)
            rows = list(rows)
            assert names(source.readBetweenOffsets(offset, json.loads(json.dumps(end)))) == names(rows) and len(rows) <= 3
            got, offset = got + rows, json.loads(json.dumps(end))
    while True:
        rows, offset = source.read(offset)
        rows = list(rows)
        if not rows:
            break
        got += rows
    assert names(got) == sorted(put_names)
    assert sum(len(s["names"]) for s in offset["days"].values()) < 20


def test_closed_dates_are_not_listed_again(tmp_path, monkeypatch):
    for day in ("20251110", "20251111", "20251112"):
        put(tmp_path, day, f"a-{day}", 1000)
    (tmp_path / "not-a-date").mkdir()
    source = reader(tmp_path)
    rows, offset = source.read(source.initialOffset())
    assert len(list(rows)) == 3 and offset["closed"] == "20251111" and list(offset["days"]) == ["20251112"]
    listed = []
    files = DatedFolders._files
    monkeypatch.setattr(DatedFolders, "_files", lambda self, day: listed.append(day) or files(self, day))
    put(tmp_path, "20251110", "too-late", 2000)
    put(tmp_path, "20251112", "b", 2000)
    rows, after = reader(tmp_path).read(offset)  # a reader that has been started again
    assert names(rows) == ["b"] and listed == ["20251112"]
    assert reader(tmp_path).read(after)[1] == after


def test_a_full_batch_keeps_a_date_open(tmp_path):
    for i in range(5):
        put(tmp_path, "20251110", f"n{i}", 1000 + i)
    put(tmp_path, "20251115", "m", 1000)
    source = reader(tmp_path, maxFiles=3)
    rows, offset = source.read(source.initialOffset())
    assert names(rows) == ["n0", "n1", "n2"] and offset["closed"] == ""
    rows, offset = source.read(offset)
    assert names(rows) == ["m", "n3", "n4"] and offset["closed"] == "20251110"
    assert list(source.read(offset)[0]) == []
    assert list(reader(tmp_path / "absent").read(source.initialOffset())[0]) == []


def test_dated_ingestion_equals_what_landed(spark, tmp_path):
    base, table, offsets = tmp_path / "landing", str(tmp_path / "bronze"), str(tmp_path / "offsets")
    body = lambda trip: json.dumps({"trip_updates": [{"trip_id": trip}]}, indent=2)
    for i in range(5):
        put(base, "20251114", f"a_20251114_10000{i}", 1000 + i, body(f"t{i}"))
    trips = lambda: sorted(r.trip_id for r in read_bronze(spark, table, "trip_updates").collect())
    ingest_once(spark, str(base), table, offsets, "trip_updates", dated=True, files_per_batch=2)
    assert trips() == [f"t{i}" for i in range(5)]
    put(base, "20251115", "a_20251115_100000", 2000, body("u"))
    put(base, "20251114", "a_20251114_090000", 999, body("late"))
    ingest_once(spark, str(base), table, offsets, "trip_updates", dated=True, files_per_batch=2)
    assert trips() == ["late", *[f"t{i}" for i in range(5)], "u"]
    assert landing.DatedLanding.name() == "dated_landing"
