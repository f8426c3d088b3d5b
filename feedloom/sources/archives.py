"""Tar archives of snapshot documents.

Plain archives are indexed first (headers only), then the members are spread over the
cluster and read by offset, so one huge archive does not keep one task busy alone. A
compressed archive has no random access: one task streams it member by member.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.names import FEED_MARKS, classify_feed
from feedloom.operators.filters import feed_types
from feedloom.sources.files import list_files, open_filesystem

_INDEX = "archive STRING, member STRING, offset BIGINT, size BIGINT, problem STRING"
_MEMBERS = "archive STRING, member STRING, content BINARY, problem STRING"
_INDEX_COLUMNS, _MEMBER_COLUMNS = ([c.split()[0] for c in s.split(", ")] for s in (_INDEX, _MEMBERS))
_BATCH_BYTES = 16 << 20


def _wanted(member) -> bool:
    return member.isfile() and member.name.endswith(".json")


def _is_compressed(path):
    return path.rlike(r"(?i)\.(tgz|tbz2?|txz|gz|bz2|xz)$")


def _index_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import tarfile

    for batch in batches:
        for path in batch["path"]:
            filesystem, target = open_filesystem(path)
            found = []
            try:
                with filesystem.open_input_file(target) as raw, tarfile.open(fileobj=raw, mode="r:") as tar:
                    for member in tar:
                        tar.members = []
                        if _wanted(member):
                            found.append((path, member.name, member.offset_data, member.size, None))
                        if len(found) >= 10000:
                            yield pd.DataFrame(found, columns=_INDEX_COLUMNS)
                            found = []
                    if raw.size() < tar.offset + tarfile.BLOCKSIZE:
                        found.append((path, None, 0, 0, "no end mark"))
            except (tarfile.TarError, EOFError, ValueError) as error:
                # A damaged archive keeps what was readable, and is reported.
                # Storage errors (OSError) are left to Spark's task retry.
                found.append((path, None, 0, 0, str(error) or type(error).__name__))
            if found:
                yield pd.DataFrame(found, columns=_INDEX_COLUMNS)


class _Batches:
    """Member rows given out in batches of about ``_BATCH_BYTES``; a larger member has one of its own, without copies."""

    def __init__(self):
        self.rows, self.held = [], 0

    def add(self, archive: str, member: str | None, content: bytes | None, problem: str | None = None) -> Iterator[pa.RecordBatch]:
        size = len(content or b"")
        if self.held + size > _BATCH_BYTES:
            yield from self.rest()
        self.rows.append((archive, member, content, problem))
        self.held += size
        if self.held >= _BATCH_BYTES:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if not self.rows:
            return
        archives, members, contents, problems = zip(*self.rows)
        self.rows, self.held = [], 0
        if len(contents) == 1 and contents[0] is not None:
            ends = pa.array([0, len(contents[0])], pa.int32()).buffers()[1]
            column = pa.Array.from_buffers(pa.binary(), 1, [None, ends, pa.py_buffer(contents[0])])
        else:
            column = pa.array(contents, pa.binary())
        texts = [pa.array(values, pa.string()) for values in (archives, members, problems)]
        yield pa.record_batch([*texts[:2], column, texts[2]], names=_MEMBER_COLUMNS)


def _read_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive, wanted in batch.to_pandas().groupby("archive", sort=False):
            filesystem, target = open_filesystem(archive)
            out = _Batches()
            with filesystem.open_input_file(target) as raw:
                for member, offset, size, problem in zip(wanted["member"], wanted["offset"], wanted["size"], wanted["problem"]):
                    if problem is not None:
                        yield from out.add(archive, None, None, problem)
                        continue
                    content = raw.read_at(int(size), int(offset))
                    if len(content) < size:
                        yield from out.add(archive, member, None, f"{len(content)} of {size} bytes")
                        continue
                    yield from out.add(archive, member, content)
            yield from out.rest()


def _stream_members(batches: Iterator[pa.RecordBatch], marks: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    import lzma
    import tarfile
    import zlib

    for batch in batches:
        for path in batch["path"].to_pylist():
            filesystem, target = open_filesystem(path)
            out = _Batches()
            try:
                with (
                    filesystem.open_input_stream(target, compression=None) as raw,
                    tarfile.open(fileobj=raw, mode="r|*") as tar,
                ):
                    for member in tar:
                        tar.members = []
                        # Members of no selected feed are passed over without being kept.
                        if not _wanted(member) or not any(mark in member.name for mark in marks):
                            continue
                        yield from out.add(path, member.name, tar.extractfile(member).read())
            except (tarfile.TarError, EOFError, ValueError, zlib.error, lzma.LZMAError) as error:
                yield from out.add(path, None, None, str(error) or type(error).__name__)
            yield from out.rest()


def archive_index(spark: SparkSession, base: str, pattern: str = "*.tar*") -> DataFrame:
    """(archive, member, offset, size, feed_type) of the JSON members of uncompressed archives."""
    plain = list_files(spark, base, pattern).where(~_is_compressed(F.col("path"))).select("path")
    return plain.mapInPandas(_index_members, _INDEX).withColumn("feed_type", classify_feed(F.col("member")))


def _read_tasks(index: DataFrame) -> int:
    """As many tasks as the indexed bytes fill input splits, and at least two per core."""
    spark = index.sparkSession
    split = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    held = index.agg(F.sum("size")).first()[0] or 0
    return max(2 * spark.sparkContext.defaultParallelism, -(-held // split))


def scan_archives(spark: SparkSession, base: str, pattern: str = "*.tar*", selection: str = "both") -> DataFrame:
    """(archive, member, feed_type, content, problem): members of the selected feeds, and what could
    not be read: a damaged archive (no member) or a member that is cut short, each with ``problem``.

    The feed is decided from the member path; contents of other members are not read from
    plain archives.
    """
    selected = feed_types(selection)
    marks = tuple(mark for mark, feed in FEED_MARKS.items() if feed in selected)
    wanted = classify_feed(F.col("member")).isin(*selected) | F.col("problem").isNotNull()
    index = archive_index(spark, base, pattern).where(wanted)
    # A given number of partitions is left alone, so members of one archive stay spread.
    spread = index.select(*_INDEX_COLUMNS).repartition(_read_tasks(index), "archive", "member", "offset")
    plain = spread.mapInArrow(_read_members, _MEMBERS)

    packed_paths = list_files(spark, base, pattern).where(_is_compressed(F.col("path"))).select("path")
    # Parsing costs more than inflating, so the members of one archive are spread out for it.
    stream = lambda batches: _stream_members(batches, marks)
    packed = packed_paths.mapInArrow(stream, _MEMBERS).where(wanted).repartition("archive", "member")

    return plain.unionByName(packed).select(
        "archive",
        "member",
        classify_feed(F.col("member")).alias("feed_type"),
        F.col("content").cast("string").alias("content"),
        "problem",
    )


def read_archives(spark: SparkSession, base: str, pattern: str = "*.tar*", selection: str = "both") -> DataFrame:
    """(archive, member, feed_type, content) of every readable member of a selected feed."""
    return scan_archives(spark, base, pattern, selection).where("problem is null").drop("problem")
