"""Files and containers: round trips, damage, several archives, oversized groups."""

import io
import json
import tarfile
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedloom import cli
from feedloom.functions.clock import ts_to_stamp
from feedloom.operators.reports import document_log, ingest_report, static_profile
from feedloom.plans import fixtures, normalise
from feedloom.session import fresh_dir, shared_dir
from feedloom.sources import archives, bronze, documents, protobuf, snapshots, static
from feedloom.sources.files import PIECE_BYTES, in_pieces, read_payloads, write_named_files


def document(agency, trip, timestamp=1763124553):
    return json.dumps({"feed_name": agency, "timestamp": timestamp, "trip_updates": [{"trip_id": trip, "vehicle_id": "v"}]}, indent=2)


def write_tar(path, members, mode="w"):
    with tarfile.open(path, mode) as tar:
        for name, text in members:
            data = text.encode()
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))


@pytest.fixture
def archive_dir(tmp_path):
    base = tmp_path / "archives"
    base.mkdir()
    write_tar(base / "a.tar", [("x/trip_updates/1.json", document("harbour-tram", "t1")), ("x/alerts/2.json", "{}"), ("x/trip_updates/readme.txt", "no"),
                               ("x/vehicle_position_1.json", json.dumps({"timestamp": 1763124553, "vehicle_positions": [{"vehicle_id": "q_w_1"}]}))])
    write_tar(base / "b.tar.gz", [("trip_update_9.json", document("harbour-tram", "t2")), ("trip_update_8.json", '{"broken'), ("trip_update_7.json", document("harbour-bus", "t3"))], "w:gz")
    whole = io.BytesIO()
    write_tar(base / "c.tar", [(f"trip_updates_{i}.json", document("harbour-bus", f"c{i}")) for i in range(50)])
    whole = (base / "c.tar").read_bytes()
    (base / "c.tar").write_bytes(whole[: len(whole) // 2])
    (base / "d.tar.gz").write_bytes(b"not an archive")
    (base / "e.tar").write_bytes(b"")
    return str(base)


def test_archives_are_read_member_by_member(spark, archive_dir):
    rows = archives.read_archives(spark, archive_dir)
    good = rows.where(~F.col("archive").contains("/c.tar"))
    got = sorted((r.archive.rsplit("/", 1)[1], r.member, r.feed_type) for r in good.collect())
    assert got == [
        ("a.tar", "x/trip_updates/1.json", "trip_updates"),
        ("a.tar", "x/vehicle_position_1.json", "vehicle_positions"),
        ("b.tar.gz", "trip_update_7.json", "trip_updates"),
        ("b.tar.gz", "trip_update_8.json", "trip_updates"),
        ("b.tar.gz", "trip_update_9.json", "trip_updates"),
    ]
    # A cut archive gives what is whole in it.
    assert rows.where(F.col("archive").contains("/c.tar")).count() == 30
    assert archives.read_archives(spark, archive_dir, selection="vehicle_positions").count() == 1


def test_archives_to_bronze(spark, archive_dir, tmp_path):
    base = str(tmp_path / "bronze")
    normalise.normalise_archives(spark, archive_dir, base, "[ab].tar*")
    rows = bronze.read_bronze(spark, base, "trip_updates").collect()
    # One agency and date from two archives: rows of both.
    assert sorted((r.agency, r.date_str_jst, r.trip_id) for r in rows) == [
        ("harbour_bus", "20251114", "t3"), ("harbour_tram", "20251114", "t1"), ("harbour_tram", "20251114", "t2")
    ]
    assert {r.snapshot_filename for r in rows if r.trip_id == "t1"} == {"gtfs_rt_trip_updates_harbour_tram_20251114_214913.json"}
    assert [r.agency for r in bronze.read_bronze(spark, base, "vehicle_positions").collect()] == ["q_w"]
    only = str(tmp_path / "only")
    normalise.normalise_archives(spark, archive_dir, only, "[ab].tar*", agencies="harbour_bus, other", selection="trip_updates")
    assert [r.trip_id for r in bronze.read_bronze(spark, only, "trip_updates").collect()] == ["t3"]
    report = {r.agency: r for r in normalise.archive_agencies(spark, archive_dir, "[ab].tar*", "harbour_bus").collect()}
    assert (report["harbour_tram"].trip_updates, report["harbour_tram"].processed, report[None].processed, report[None].skipped) == (2, 0, 1, 4)


def test_folder_to_bronze_by_command_line(spark, tmp_path):
    landing = tmp_path / "landing" / "deep"
    landing.mkdir(parents=True)
    (landing / "gtfs_rt_trip_updates_harbour_tram_20251114_214913.json").write_text(document("x", "t1"))
    (landing / "gtfs_rt_trip_updates_20251399_000000.json").write_text(document("x", "t2"))
    (landing / "gtfs_rt_trip_updates_harbour_bus_20251114_214913.json").write_text('{"trip_updates": [')
    (landing / "notes.json").write_text(document("x", "t3"))
    base = str(tmp_path / "bronze")
    normalise.normalise_folder(spark, str(tmp_path / "landing"), base, "trip_updates", quarantine_dir=str(tmp_path / "bad"))
    assert [r.trip_id for r in bronze.read_bronze(spark, base, "trip_updates").collect()] == ["t1"]
    bad = spark.read.parquet(str(tmp_path / "bad" / "trip_updates")).collect()
    assert sorted((r.status, r.snapshot_filename) for r in bad) == [
        ("bad_json", "gtfs_rt_trip_updates_harbour_bus_20251114_214913.json"), ("bad_name", "gtfs_rt_trip_updates_20251399_000000.json")
    ]
    again = str(tmp_path / "again")
    cli.main(["normalise", "--input-dir", str(tmp_path / "landing"), "--output-dir", again, "--feed-type", "trip_updates", "--agency-filter", "harbour_tram"])
    assert bronze.read_bronze(spark, again, "trip_updates").count() == 1


def test_static_bundles(spark, tmp_path):
    base = tmp_path / "bundles"
    base.mkdir()
    with zipfile.ZipFile(base / "one.zip", "w") as z:
        z.writestr("stop_times.txt", "﻿trip_id,stop_id,departure_time,extra\r\nwd_a_r_1,007,25:10:05,\r\nwd_a_r_2,008,26:00:00,x\r\n")
        z.writestr("stops.txt", "stop_id,stop_name\n007,A\n" + "008,B,too,many\n")
        z.writestr("shapes.txt", "ignored\n1\n")
        z.writestr("agency.txt", "agency_id\n")
    (base / "two.zip").write_bytes(b"PK broken")
    rows = static.read_static_bundles(spark, str(base))
    problems = {(r.archive.rsplit("/", 1)[1], r.table) for r in rows.where("problem is not null").collect()}
    assert problems == {("one.zip", "stops"), ("two.zip", None)}
    good = static.good_rows(rows)
    assert [r.table for r in good.select("table").distinct().collect()] == ["stop_times"]
    times = static.static_table(good, "stop_times", ["stop_id", "departure_time", "extra", "absent"]).drop("archive")
    assert sorted(map(tuple, times.collect())) == [("007", "25:10:05", None, None), ("008", "26:00:00", "x", None)]
    profile = static_profile(good).first()
    assert (profile.rows, profile.columns) == (2, ["departure_time", "extra", "stop_id", "trip_id"])
    assert json.loads(profile.sample)["stop_id"] == "007"


def test_one_table_is_parsed_by_several_tasks_and_unwanted_ones_stay_closed(spark, tmp_path):
    base, lines = tmp_path / "bundles", 300_000
    base.mkdir()
    text = "trip_id,stop_id,departure_time\n" + "".join(f"wd_a_r_{i},s{i % 7},10:00:00\n" for i in range(lines))
    with zipfile.ZipFile(base / "one.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("stop_times.txt", text)
        z.writestr("stops.txt", "stop_id\n" + "x" * 1000)
    data = bytearray((base / "one.zip").read_bytes())
    at = data.rindex(b"stops.txt", 0, data.rindex(b"PK\x01\x02") - 10)
    data[at + 12] ^= 0xFF  # the unwanted table no longer inflates
    (base / "one.zip").write_bytes(bytes(data))
    rows = static.read_static_bundles(spark, str(base), tables=["stop_times"])
    assert rows.where("problem is not null").count() == 0
    per_task = rows.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 1 and sum(r["count"] for r in per_task) == lines
    assert rows.agg(F.count_distinct("line_no"), F.max("line_no")).first()[:] == (lines, lines)
    everything = static.read_static_bundles(spark, str(base))
    assert [r.table for r in everything.where("problem is not null").collect()] == ["stops"]
    assert everything.where("problem is null").count() == lines


def test_quotes_blank_lines_and_line_ends_of_bundles(spark, tmp_path):
    base = tmp_path / "bundles"
    base.mkdir()
    with zipfile.ZipFile(base / "one.zip", "w") as z:
        z.writestr("stops.txt", '\r\nstop_id,"stop, name",stop_id\r\n\r\n1,"a ""quoted"", one\r\nof two lines",9\r\n\r\n2\n3,é,"  "')
        z.writestr("trips.txt", 'trip_id\n1\n"open\n')
        z.writestr("routes.txt", b"route_id\n\xff\n")
        z.writestr("calendar.txt", "a,b\n" + "1,2\n" * 10 + "1,2,\n")
        z.writestr("agency.txt", "")
    rows = static.read_static_bundles(spark, str(base))
    assert {r.table for r in rows.where("problem is not null").collect()} == {"trips", "routes", "calendar"}
    got = sorted((r.line_no, r.row) for r in rows.where("problem is null").collect())
    assert got == [
        (1, {"stop_id": "9", "stop, name": 'a "quoted", one\r\nof two lines'}),
        (2, {"stop_id": None, "stop, name": None}),
        (3, {"stop_id": "  ", "stop, name": "é"}),
    ]


def test_records_are_cut_alike_whatever_the_blocks(spark):
    text = 'id,name\n1,"x\n,y"\n\n2,é\n3,"q""q"\n'.encode()
    for size in range(1, len(text) + 1):
        records, got = static._Records(), []
        chunks = [text[i : i + size] for i in range(0, len(text), size)]
        try:
            for i, chunk in enumerate(chunks):
                found = records.block(chunk, i == len(chunks) - 1)
                got += [] if found is None else [(found[0] + j, r.strip()) for j, r in enumerate(found[1].to_pylist())]
        except UnicodeDecodeError:
            raise AssertionError(size)
        assert got == [(1, '1,"x\n,y"'), (2, "2,é"), (3, '3,"q""q"')], size


def test_static_json_with_nan(spark, tmp_path):
    body = '{"feed_url": "u", "feed_name": "f", "timestamp": "s", "tables": {"stops": [{"stop_id": 7, "stop_name": NaN}], "trips": []}}'
    (tmp_path / "gtfs_static_f_20251114_214913.json").write_text(body)
    rows = static.read_static_json(spark, str(tmp_path)).collect()
    assert [(r.feed_name, r.stamp, r.table, r.row) for r in rows] == [("f", "s", "stops", {"stop_id": "7", "stop_name": None})]


def test_any_number_of_parts_gives_the_same_answers(spark, tmp_path):
    n = 5000
    items = spark.range(n).select(
        F.lit("trip_updates").alias("feed_type"),
        F.when(F.col("id") < 4900, "hot").otherwise("cold").alias("label"),
        F.lit("20251114_214913").alias("stamp"),
        F.col("id").alias("trip"),
    )
    answers = []
    for parts in (1, 7):
        base = str(tmp_path / f"landing{parts}")
        make = lambda rows: documents.snapshot_documents(rows, F.struct(F.col("trip").cast("string").alias("trip_id")), parts=parts)
        documents.write_documents(make(items), base)
        documents.write_documents(make(items.where("trip % 50 = 0")), base)  # the same cycle again, with fewer items
        rows = normalise.snapshot_rows(spark, base, "trip_updates")
        docs = snapshots.documents_from_names(snapshots.read_snapshot_files(spark, base, "trip_updates"))
        assert docs.count() == 2 * parts
        report = ingest_report(document_log(docs)).drop("bytes")
        answers.append((sorted(map(tuple, rows.collect()), key=str), sorted(map(tuple, report.collect()), key=str)))
    assert answers[0] == answers[1] and len(answers[0][0]) == 100


def test_static_documents_in_parts(spark, tmp_path):
    rows = spark.range(100).select(
        F.lit("f").alias("label"), F.lit("20251114_214913").alias("stamp"), F.lit("stops").alias("table"), F.col("id").alias("line_no"),
        F.create_map(F.lit("stop_id"), F.col("id").cast("string")).alias("row"),
    )
    for parts in (1, 3):
        base = str(tmp_path / f"static{parts}")
        documents.write_documents(documents.static_documents(rows, parts=parts), base)
        got = sorted(int(r.row["stop_id"]) for r in static.read_static_json(spark, base).collect())
        assert got == list(range(100))


def test_schedule_rows_without_a_line_number_are_kept(spark):
    schema = "label string, stamp string, table string, line_no bigint, row map<string,string>"
    rows = [("f", "20251114_214913", "stops", n, {"stop_id": v}) for n, v in ((None, "z"), (2, "b"), (None, "y"), (1, "a"), (None, "y"))]
    df = spark.createDataFrame([*rows, ("f", "20251114_214913", "trips", None, None)], schema)
    whole = json.loads(documents.static_documents(df).first().content)
    assert [r["stop_id"] for r in whole["tables"]["stops"]] == ["a", "b", "y", "y", "z"] and whole["tables"]["trips"] == []
    parts = [json.loads(r.content)["tables"].get("stops", []) for r in documents.static_documents(df, parts=3).collect()]
    assert sorted(r["stop_id"] for part in parts for r in part) == ["a", "b", "y", "y", "z"]


def test_damage_is_reported(spark, archive_dir):
    rows = archives.scan_archives(spark, archive_dir)
    broken = {r.archive.rsplit("/", 1)[1] for r in rows.where("problem is not null").collect()}
    assert broken == {"c.tar", "d.tar.gz"}  # files without a byte are not listed at all
    docs = normalise.archive_documents(spark, archive_dir)
    assert snapshots.quarantine(docs).where("status = 'bad_archive'").count() == 2
    report = {r.agency: r for r in normalise.archive_agencies(spark, archive_dir, "[de].tar*").collect()}
    assert (report["(none)"].documents, report["(none)"].skipped) == (1, 1)


def test_one_large_archive_is_read_by_several_tasks(spark, tmp_path):
    write_tar(tmp_path / "big.tar", [(f"trip_updates_{i}.json", document("a", f"t{i}") + " " * 100_000) for i in range(64)])
    rows = archives.read_archives(spark, str(tmp_path))
    assert rows.select(F.spark_partition_id().alias("p")).distinct().count() >= 4 and rows.count() == 64


def test_files_are_cut_into_pieces_and_written_whole(spark, tmp_path):
    texts = {"a/empty": b"", "a/one": b"x" * PIECE_BYTES, "a/more": bytes(range(256)) * (PIECE_BYTES // 100)}
    rows = spark.createDataFrame(list(texts.items()), "name string, content binary")
    sizes = in_pieces(rows, "name").groupBy("name").agg(F.count("*").alias("n"), F.max(F.octet_length("content")).alias("most")).collect()
    assert {r["name"]: (r.n, r.most) for r in sizes} == {"a/empty": (1, 0), "a/one": (1, PIECE_BYTES), "a/more": (3, PIECE_BYTES)}
    write_named_files(rows, str(tmp_path))
    assert {f"a/{p.name}": p.read_bytes() for p in (tmp_path / "a").iterdir()} == texts


@pytest.mark.parametrize("packed", [False, True])
def test_archives_of_large_documents_are_built_and_read_in_bounded_batches(spark, tmp_path, packed):
    sizes = [0, 511, 512, PIECE_BYTES, 3 * PIECE_BYTES + 7, 9 * PIECE_BYTES, 20 * PIECE_BYTES]
    body = F.expr("concat_ws('', transform(sequence(0, cast(size / 32 as int)), i -> md5(cast(i * 1000 + size as string))))")
    docs = spark.createDataFrame([(n,) for n in sizes], "size int").coalesce(2).select(
        F.concat(F.lit("x/trip_updates_"), "size", F.lit(".json")).alias("name"), F.lit(0).alias("part"), F.substr(body, F.lit(1), F.col("size")).alias("content")
    )
    fixtures.write_archives(docs, str(tmp_path), packed=packed)
    rows = archives.scan_archives(spark, str(tmp_path))
    got = {r.member: (r.n, r.md5) for r in rows.select("member", F.length("content").alias("n"), F.md5("content").alias("md5"), "problem").where("problem is null").collect()}
    assert rows.count() == len(sizes) and got == {f"feeds/000000/{r['name'][2:]}": (len(r.content), r.md5) for r in docs.withColumn("md5", F.md5("content")).collect()}
    # A member above the batch size is alone in its batch, so no other content is held with it.
    paths = [pa.record_batch({"path": sorted(str(p) for p in tmp_path.iterdir())})]
    found = archives._stream_members(iter(paths), ("trip_update",)) if packed else archives._read_members(map(pa.RecordBatch.from_pandas, archives._index_members(b.to_pandas() for b in paths)))
    held = [(b.num_rows, sum(len(c or b"") for c in b["content"].to_pylist())) for b in found]
    assert all(size <= 16 * PIECE_BYTES or n == 1 for n, size in held) and sum(size for _, size in held) == sum(sizes)


def _positions(n):
    feed = protobuf.feed_message_class()()
    feed.header.gtfs_realtime_version, feed.header.timestamp = "2.0", 1763124553
    for i in range(n):
        vehicle = feed.entity.add(id=f"e{i}").vehicle
        vehicle.trip.trip_id, vehicle.trip.route_id, vehicle.vehicle.id, vehicle.timestamp = f"t{i}", "r", "v", 1763124553 + i
        if i % 3:
            vehicle.position.latitude = i
    return feed


def test_a_large_payload_is_decoded_in_stretches(monkeypatch):
    whole, parsed = protobuf.feed_message_class(), []
    data = _positions(30_000).SerializeToString()
    late = whole()  # a header that ends the payload adds to the first one
    late.header.timestamp = 7

    class Watched:
        def __new__(cls):
            feed = whole()

            class Feed:
                ParseFromString = staticmethod(lambda text: (parsed.append(len(text)), feed.ParseFromString(text)))
                __getattr__ = lambda self, name: getattr(feed, name)

            return Feed()

    monkeypatch.setattr(protobuf, "feed_message_class", lambda: Watched)
    texts = {"whole": data + late.SerializeToString(), "cut": data[:-1], "unknown": b"\x7b\x08\x01\x7c" + data[:20], "odd": b"\x98\x06\x05" + data, "none": b""}
    decode = protobuf._decoder("vehicle", protobuf._position_values, "vehicle_positions", protobuf._POSITION_TYPE)
    got = {r["path"]: r for b in decode(iter([pa.record_batch({"path": list(texts), "content": list(texts.values())})])) for r in b.to_pylist()}
    assert max(parsed) < 2 * protobuf._STRETCH_BYTES < len(data)
    for name, text in texts.items():
        feed, row = whole(), got[name]
        try:
            feed.ParseFromString(text)
        except Exception:
            assert name in ("cut", "unknown") and (row["timestamp"], row["gtfs_realtime_version"], row["vehicle_positions"]) == (None, None, None)
            continue
        assert (row["timestamp"], row["gtfs_realtime_version"]) == (feed.header.timestamp, feed.header.gtfs_realtime_version)
        assert row["vehicle_positions"] == [protobuf._position_values(e.vehicle) for e in feed.entity]


def test_payloads_are_built_row_by_row(spark):
    item = "struct<id: string, trip_id: string, route_id: string, vehicle_id: string, timestamp: bigint, position: struct<latitude: double>>"
    n, feed = 25_000, _positions(25_000)
    value = F.struct(
        F.concat(F.lit("e"), "id").alias("id"), F.concat(F.lit("t"), "id").alias("trip_id"), F.lit("r").alias("route_id"), F.lit("v").alias("vehicle_id"),
        (F.col("id") + 1763124553).alias("timestamp"), F.when(F.col("id") % 3 > 0, F.struct(F.col("id").cast("double").alias("latitude"))).alias("position"),
    ).cast(item)
    keyed = lambda label, rows, entity: rows.select(F.lit(label).alias("label"), F.lit("vehicle_positions").alias("feed_type"), F.lit(1763124553).cast("bigint").alias("timestamp"), entity.alias("entity"))
    rows = keyed("full", spark.range(n), value).unionByName(keyed("empty", spark.range(2), F.lit(None).cast(item)))
    got = {r.label: protobuf.feed_message_class().FromString(bytes(r.content)) for r in protobuf.encode_entities(rows, ["label", "feed_type", "timestamp"]).collect()}
    order = lambda found: sorted(e.SerializeToString() for e in found.entity)
    assert got["full"].header.SerializeToString() == got["empty"].header.SerializeToString() == feed.header.SerializeToString()
    assert order(got["full"]) == order(feed) and len(got["empty"].entity) == 0


def test_payloads_to_bronze_report_what_cannot_be_read(spark, tmp_path):
    (tmp_path / "gtfs_rt_trip_updates_a_20251114_214913.pb").write_bytes(b"\xff\xff\xff")
    payloads = read_payloads(spark, str(tmp_path), "*.pb")
    docs = normalise.payload_documents(payloads, "trip_updates")
    assert [r.status for r in snapshots.quarantine(docs).collect()] == ["bad_json"]


def test_shared_folder_is_required_on_a_cluster():
    from feedloom.session import _local_folder

    assert _local_folder("local[8]") and _local_folder("local")
    for master in ("local-cluster[3,2,1024]", "yarn", "spark://host:7077", "k8s://host"):
        with pytest.raises(ValueError):
            _local_folder(master)


def test_payloads(spark, tmp_path):
    message = protobuf.feed_message_class()
    feed = message()
    feed.header.gtfs_realtime_version = "2.0"
    feed.header.timestamp = 1763124553
    update = feed.entity.add(id="1").trip_update
    update.trip.trip_id = "t1"
    vehicle = feed.entity.add(id="2").vehicle
    vehicle.position.latitude = 36.5
    vehicle.current_status = 0
    feed.entity.add(id="3").vehicle.vehicle.id = "v3"
    (tmp_path / "good.pb").write_bytes(feed.SerializeToString())
    (tmp_path / "bad.pb").write_bytes(b"\xff\xff\xff")
    payloads = read_payloads(spark, str(tmp_path), "*.pb")
    updates = {r.path.rsplit("/", 1)[1]: r for r in protobuf.decode_trip_updates(payloads).collect()}
    assert updates["bad.pb"].trip_updates is None and updates["good.pb"].timestamp == 1763124553
    assert [tuple(i) for i in updates["good.pb"].trip_updates] == [("t1", "", 0, "", "", None, 0, None)]
    positions = {r.path.rsplit("/", 1)[1]: r for r in protobuf.decode_vehicle_positions(payloads).collect()}["good.pb"].vehicle_positions
    assert [(i.vehicle_id, i.current_status, i.position and i.position.latitude) for i in positions] == [("", 0, 36.5), ("v3", 2, None)]
    # The known wire form of a feed header: field 1 "2.0", field 3 as a varint.
    assert message.FromString(b"\x0a\x05\x0a\x032.0").header.gtfs_realtime_version == "2.0"
    stamp = ts_to_stamp(F.lit("2025-11-14 21:49:13").cast("timestamp_ntz"))
    documents.archive_payloads(payloads, str(tmp_path / "raw"), "trip_updates", F.lit("tram"), stamp)
    kept = spark.read.parquet(str(tmp_path / "raw"))
    assert {r.name for r in kept.collect()} == {"gtfs_rt_trip_updates_tram_20251114_214913.pb"}
    assert kept.where("octet_length(content) = length").count() == 2


def test_named_files_are_replaced_whole(spark, tmp_path):
    base = str(tmp_path / "out")
    for text in ("first", "second"):
        write_named_files(spark.createDataFrame([("a/b.json", text.encode())], "name STRING, content BINARY"), base)
    assert (tmp_path / "out" / "a" / "b.json").read_text() == "second"
    assert [p.name for p in (tmp_path / "out" / "a").iterdir()] == ["b.json"]


def test_shared_dir_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    base = shared_dir(spark)
    assert configured is None or base == configured
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x") and fresh_dir(spark, "x").startswith(base.rstrip("/"))


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "stop_times.txt").write_text("stop_sequence,departure_time,trip_id,stop_id\n1,07:00:00,wd_a_r_1,007\n")
    assert tuple(static.read_stop_times_csv(spark, str(tmp_path / "stop_times.txt")).first()) == ("wd_a_r_1", "007", "07:00:00")
    cli.main(["headway", "--stop-times", str(tmp_path / "stop_times.txt"), "--output-dir", str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out" / "by_route_and_stop")).count() == 1


def test_quirks_are_switches(spark, tmp_path):
    (tmp_path / "gtfs_rt_trip_updates_20251114_214913.json").write_text(document("x", "t"))
    files = snapshots.read_snapshot_files(spark, str(tmp_path), "trip_updates")
    assert snapshots.documents_from_names(files).first().agency == "v"
    assert snapshots.documents_from_names(files, first_entity_only=True).first().agency == "unknown"
