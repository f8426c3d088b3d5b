"""Documents, archives, bundles and payloads that Spark derives from the events views.

They let the file operators run end to end on the given tables: everything is built in
bounded pieces by tasks and written to fresh folders in the shared scratch space.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.clock import epoch_seconds, ts_to_stamp
from feedloom.functions.names import artifact_name
from feedloom.plans.views import view
from feedloom.session import fresh_dir
from feedloom.sources.documents import in_parts, snapshot_documents, write_documents
from feedloom.sources.files import PIECE_BYTES, in_pieces, write_named_files, write_pieces
from feedloom.sources.protobuf import encode_entities

_KEYS = ["feed_type", "label", "stamp", "timestamp"]
PACK_BYTES = 8 << 20
BUNDLE_ROWS = 20000


def cycle(unit: str = "day") -> Column:
    """Wall clock of the collection cycle a row belongs to."""
    return F.date_trunc(unit, "snapshot_ts_jst").cast("timestamp_ntz")


def cycle_rows(spark: SparkSession, sf_dir: str, feed_type: str, unit: str = "day") -> DataFrame:
    """Rows of a view with the keys of the document they go into."""
    rows = view(spark, sf_dir, "tu" if feed_type == "trip_updates" else "vp")
    return rows.withColumns(
        {
            "feed_type": F.lit(feed_type),
            "label": F.col("agency"),
            "stamp": ts_to_stamp(cycle(unit)),
            "timestamp": epoch_seconds(cycle(unit), 9),
            "item_time": epoch_seconds(F.col("snapshot_ts_jst"), 9),
        }
    )


def position_struct() -> Column:
    located = F.struct(F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), "speed")
    return F.when(F.col("lat").isNotNull(), located)


def flat_item(feed_type: str) -> Column:
    if feed_type == "trip_updates":
        return F.struct("trip_id", "route_id", "vehicle_id", F.col("item_time").alias("timestamp"), "delay")
    return F.struct(
        "vehicle_id",
        "trip_id",
        "route_id",
        "current_stop_sequence",
        "current_status",
        F.col("item_time").alias("timestamp"),
        position_struct().alias("position"),
    )


def entity_item(feed_type: str) -> Column:
    trip = F.struct("trip_id", "route_id").alias("trip")
    vehicle = F.struct(F.col("vehicle_id").alias("id")).alias("vehicle")
    time = F.col("item_time").alias("timestamp")
    if feed_type == "trip_updates":
        body = F.struct(trip, vehicle, time, "delay").alias("trip_update")
    else:
        body = F.struct(
            trip, vehicle, position_struct().alias("position"), "current_stop_sequence", "current_status", time
        ).alias("vehicle")
    return F.struct(entity_id().alias("id"), body)


def entity_id() -> Column:
    return F.concat(F.lit("e"), F.col("event_id").cast("string"))


def flat_documents(rows: DataFrame, feed_type: str, parts: int = 1) -> DataFrame:
    return snapshot_documents(rows, flat_item(feed_type), extra={"timestamp": F.col("timestamp")}, parts=parts)


def entity_documents(rows: DataFrame, feed_type: str) -> DataFrame:
    keyed = rows.select(*_KEYS, entity_item(feed_type).alias("_item"))
    grouped = in_parts(keyed, _KEYS, 1, ["_item"]).groupBy(*_KEYS, "part").agg(F.collect_list("_item").alias("entity"))
    content = F.to_json(
        F.struct(F.struct(F.lit("2.0").alias("gtfs_realtime_version"), "timestamp").alias("header"), "entity")
    )
    name = artifact_name(F.lit("rt_json"), F.col("feed_type"), F.col("label"), F.col("stamp"))
    return grouped.select(name.alias("name"), content.alias("content"), "feed_type", "label", "stamp", "part")


def documents(spark: SparkSession, sf_dir: str, feed_type: str, unit: str = "day") -> DataFrame:
    """Tram documents in the flat encoding, bus documents in the entity encoding."""
    rows = cycle_rows(spark, sf_dir, feed_type, unit)
    flat = flat_documents(rows.where("agency = 'harbour_tram'"), feed_type)
    entity = entity_documents(rows.where("agency <> 'harbour_tram'"), feed_type)
    return flat.unionByName(entity)


def as_files(docs: DataFrame) -> DataFrame:
    """Documents as the snapshot source would read them, without a file in between."""
    return docs.select(F.element_at(F.split("name", "/"), -1).alias("snapshot_filename"), F.col("name").alias("path"), "content")


def landing(spark: SparkSession, sf_dir: str, *feed_types: str) -> str:
    """Folder with the flat snapshot files of whole tables, one per agency and day."""
    base = fresh_dir(spark, "landing")
    for feed_type in feed_types:
        write_documents(flat_documents(cycle_rows(spark, sf_dir, feed_type), feed_type), base)
    return base


def _pack_tar(suffix: str, mode: str):
    """Pieces of archives from pieces of documents; an archive ends with the document that fills it."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tarfile

        from pyspark import TaskContext

        class Sink:
            data = bytearray()
            write = data.extend

        task, number, piece, held, sink, tar = TaskContext.get().partitionId(), 0, 0, 0, Sink(), None

        def put(data: bytes) -> None:
            tar.fileobj.write(data)
            tar.offset += len(data)

        def given_out() -> pa.RecordBatch:
            content = [bytes(sink.data)]
            sink.data.clear()
            return pa.record_batch({"name": [f"pack-{task:06d}-{number:04d}{suffix}"], "piece": pa.array([piece], pa.int32()), "content": content})

        for batch in batches:
            for name, part, size, at, content in zip(*[batch[c] for c in ("name", "part", "size", "piece", "content")]):
                if tar is None:
                    tar = tarfile.open(fileobj=sink, mode=mode, bufsize=PIECE_BYTES)
                if at.as_py() == 0:
                    info = tarfile.TarInfo(f"feeds/{part.as_py():06d}/{name.as_py().rsplit('/', 1)[-1]}")
                    info.size = left = size.as_py()
                    # The member's header alone: its content follows piece by piece.
                    put(info.tobuf(tar.format, tar.encoding, tar.errors))
                    held += info.size
                data = content.as_py()
                put(data)
                left -= len(data)
                if left == 0:
                    put(bytes(-info.size % tarfile.BLOCKSIZE))
                    if held >= PACK_BYTES:
                        tar.close()
                        yield given_out()
                        number, piece, held, tar = number + 1, 0, 0, None
                if len(sink.data) >= PIECE_BYTES:
                    yield given_out()
                    piece += 1
        if tar is not None:
            tar.close()
            yield given_out()

    return pack


def write_archives(docs: DataFrame, base: str, prefix: str = "plain", packed: bool = False) -> None:
    """Documents as ``.tar`` or ``.tar.gz`` archives of a few MB each."""
    pack = _pack_tar(".tar.gz" if packed else ".tar", "w|gz" if packed else "w|")
    texts = docs.select("name", "part", F.col("content").cast("binary")).withColumn("size", F.octet_length("content"))
    archives = in_pieces(texts, "name", "part", "size").mapInArrow(pack, "name STRING, piece INT, content BINARY")
    write_pieces(archives.withColumn("name", F.concat(F.lit(f"{prefix}-"), "name")), base)


def _pack_zip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import io
    import zipfile

    from pyspark import TaskContext

    task, number = TaskContext.get().partitionId(), 0

    def bundle(rows: pd.DataFrame) -> pd.DataFrame:
        nonlocal number
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as target:
            target.writestr("stop_times.txt", "\ufeff" + rows.to_csv(index=False, lineterminator="\n"))
            stops = rows[["stop_id"]].drop_duplicates()
            target.writestr("stops.txt", stops.assign(stop_name="").to_csv(index=False))
            target.writestr("shapes.txt", "shape_id\nignored\n")
        name = f"bundle-{task:06d}-{number:04d}.zip"
        number += 1
        return pd.DataFrame({"name": [name], "content": [buffer.getvalue()]})

    for batch in batches:
        for start in range(0, len(batch), BUNDLE_ROWS):
            yield bundle(batch.iloc[start : start + BUNDLE_ROWS])


def write_bundles(stop_times: DataFrame, base: str) -> None:
    """Schedule rows as ZIP bundles of at most ``BUNDLE_ROWS`` rows each."""
    write_named_files(stop_times.mapInPandas(_pack_zip, "name STRING, content BINARY"), base)


def payloads(spark: SparkSession, sf_dir: str, feed_type: str) -> DataFrame:
    """(name, content): protobuf payloads, one per agency and day or bounded part of it."""
    rows = cycle_rows(spark, sf_dir, feed_type)
    fields = ["trip_id", "route_id", "vehicle_id"]
    extra = ["delay"] if feed_type == "trip_updates" else [position_struct().alias("position")]
    keyed = rows.select(*_KEYS, F.struct(entity_id().alias("id"), *fields, F.col("item_time").alias("timestamp"), *extra).alias("entity"))
    encoded = encode_entities(in_parts(keyed, _KEYS, 1, ["entity"]), [*_KEYS, "part"])
    name = artifact_name(F.lit("rt_raw"), F.col("feed_type"), F.col("label"), F.col("stamp"))
    return encoded.select(F.concat(F.format_string("part-%06d/", "part"), name).alias("name"), "content")
