"""Files by name: listing, opening from a task, and a sink that names its own files."""

from __future__ import annotations

import posixpath
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


def open_filesystem(uri: str):
    """(pyarrow filesystem, path) for a local path or any URI pyarrow knows (file, hdfs, s3, gs)."""
    from pyarrow import fs

    uri = re.sub(r"^file:/+", "/", uri)
    return fs.FileSystem.from_uri(uri)


def list_files(spark: SparkSession, base: str, pattern: str) -> DataFrame:
    """(path, length) of files below ``base``; contents are not read.

    File partitions follow size, so one large file is one task and small ones share.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(base)
        .select("path", "length")
    )


def read_payloads(spark: SparkSession, base: str, pattern: str) -> DataFrame:
    """(path, modificationTime, length, content) of files below ``base``."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(base)
    )


#: Python workers get and write files in pieces of this size, so what they hold does not follow the file.
PIECE_BYTES = 1 << 20


def in_pieces(files: DataFrame, *columns: str) -> DataFrame:
    """(columns…, piece, content): each ``content`` cut into pieces, numbered from 0, at least one a file.

    The pieces of a file stay in its task, in order.
    """
    last = F.greatest(F.ceil(F.octet_length("content") / PIECE_BYTES).cast("int") - 1, F.lit(0))
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.substr("content", i * PIECE_BYTES + 1, F.lit(PIECE_BYTES)))
    return files.select(*columns, F.posexplode(cut).alias("piece", "content"))


class _NamedFilesWriter(DataSourceWriter):
    def __init__(self, base: str):
        self.base = base

    def write(self, rows) -> WriterCommitMessage:
        filesystem, root = open_filesystem(self.base)
        made = set()
        rows = iter(rows)
        row = next(rows, None)
        while row is not None:
            target = posixpath.join(root, row["name"])
            folder, leaf = posixpath.split(target)
            if folder not in made:
                filesystem.create_dir(folder, recursive=True)
                made.add(folder)
            # A hidden name first: a lost or repeated task never shows half a file.
            staged = posixpath.join(folder, f".{leaf}.{uuid.uuid4().hex}")
            with filesystem.open_output_stream(staged, compression=None) as sink:
                sink.write(bytes(row["content"]))
                while (row := next(rows, None)) is not None and row["piece"] > 0:
                    sink.write(bytes(row["content"]))
            filesystem.move(staged, target)
        return WriterCommitMessage()


class NamedFiles(DataSource):
    """Sink: the rows ``(name STRING, piece INT, content BINARY)`` from piece 0 on become the file ``path/name``."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "name STRING, piece INT, content BINARY"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _NamedFilesWriter(self.options["path"])


def write_named_files(files: DataFrame, base: str) -> None:
    """Write every ``(name, content)`` row as its own file below ``base``."""
    write_pieces(in_pieces(files.select(F.col("name").cast("string"), F.col("content").cast("binary")), "name"), base)


def write_pieces(pieces: DataFrame, base: str) -> None:
    """Write files that come as rows ``(name, piece, content)``, those of a file one after another in one task."""
    spark, limit = pieces.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.dataSource.register(NamedFiles)
    before = spark.conf.get(limit)
    spark.conf.set(limit, str(16 * PIECE_BYTES))  # a worker holds a batch twice, as Arrow and as rows
    try:
        pieces.select("name", "piece", "content").write.format("named_files").mode("append").save(base)
    finally:
        spark.conf.set(limit, before)
