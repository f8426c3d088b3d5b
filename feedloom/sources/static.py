"""Schedule bundles: CSV files, ZIP bundles and their JSON form."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.session import fresh_dir
from feedloom.sources.files import list_files, open_filesystem
from feedloom.sources.schemas import STATIC_DOCUMENT, STATIC_TABLES, STOP_TIMES

_BLOCKS = "archive STRING, table STRING, first BIGINT, header ARRAY<STRING>, records ARRAY<STRING>, problem STRING"
_BLOCK_BYTES = 4 << 20
_QUOTE, _COMMA, _LINE_END, _RETURN = b'",\n\r'


def read_stop_times_csv(spark: SparkSession, path: str) -> DataFrame:
    """Schedule departures from CSV with a header; columns are matched by header name."""
    wanted = [field.split()[0] for field in STOP_TIMES.split(", ")]
    # Every column is read as text, so ids keep leading zeros; unused ones are pruned.
    return spark.read.option("header", True).option("inferSchema", False).csv(path).select(*wanted)


def _tables_of(batches: Iterator[pd.DataFrame], tables: tuple[str, ...]) -> Iterator[pd.DataFrame]:
    """The wanted tables that the central directories name; no table is opened."""
    import zipfile

    for path in (path for batch in batches for path in batch["path"]):
        filesystem, target = open_filesystem(path)
        try:
            with filesystem.open_input_file(target) as raw, zipfile.ZipFile(raw) as bundle:
                names = set(bundle.namelist())
            found = [(path, table, None) for table in tables if f"{table}.txt" in names]
        except (zipfile.BadZipFile, ValueError) as error:
            found = [(path, None, str(error))]
        yield pd.DataFrame(found, columns=["archive", "table", "problem"])


class _Records:
    """Cuts the bytes of a CSV file into whole records and checks them, a block at a time."""

    def __init__(self) -> None:
        self.header: list[str] | None = None
        self.rest, self.numbered = b"", 0

    def cut(self, data: bytes, last: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, offsets, fields) of the whole records of what has been read; the rest waits.

        A record ends at a line end outside quotes, so a line end inside quotes stays in its record.
        """
        data = self.rest + data
        if last and data and not data.endswith(b"\n"):
            data += b"\n"
        raw = np.frombuffer(data, np.uint8)
        outside = (np.cumsum(raw == _QUOTE) & 1) == 0 if b'"' in data else np.ones(len(raw), bool)
        ends = np.flatnonzero((raw == _LINE_END) & outside) + 1
        whole = int(ends[-1]) if len(ends) else 0
        self.rest = data[whole:]
        if last and self.rest:
            raise ValueError("a quoted field is not closed")
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        commas = np.flatnonzero((raw[:whole] == _COMMA) & outside[:whole])
        fields = np.diff(np.searchsorted(commas, offsets)) + 1
        return raw[:whole], offsets, fields

    def block(self, data: bytes, last: bool) -> tuple[int, pa.Array] | None:
        """(number of the first record, records) of the next block without header and blank lines."""
        raw, offsets, fields = self.cut(data, last)
        raw.tobytes().decode("utf-8")  # a table that is no UTF-8 is a bad table
        lengths = np.diff(offsets)
        blank = (lengths == 1) | ((lengths == 2) & (raw[offsets[:-1]] == _RETURN)) if len(lengths) else np.zeros(0, bool)
        records = pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(raw))
        keep = np.flatnonzero(~blank)
        if self.header is None and len(keep):
            self.header = next(csv.reader(io.StringIO(records[int(keep[0])].as_py(), newline="")))
            keep = keep[1:]
        if not len(keep):
            return None
        wide = keep[fields[keep] > len(self.header)]
        if len(wide):
            number = self.numbered + int(np.searchsorted(keep, wide[0])) + 1
            raise ValueError(f"line {number} has more fields than the header")
        first, self.numbered = self.numbered + 1, self.numbered + len(keep)
        return first, records.take(pa.array(keep))


def _table_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Inflate each table once; blocks of whole records go on to be parsed elsewhere."""
    kinds = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string()]

    def row(archive: str, table: str | None, first: int | None, header: list | None, records: pa.Array | None, problem: str | None):
        values = [pa.array([v], k) for v, k in zip((archive, table, first, header), kinds)]
        cells = pa.array([None], kinds[4]) if records is None else pa.ListArray.from_arrays(pa.array([0, len(records)], pa.int32()), records)
        return pa.RecordBatch.from_arrays([*values, cells, pa.array([problem], pa.string())], ["archive", "table", "first", "header", "records", "problem"])

    for batch in batches:
        for archive, table, problem in zip(*(batch.column(c).to_pylist() for c in ("archive", "table", "problem"))):
            if problem is not None:
                yield row(archive, None, None, None, None, problem)
                continue
            filesystem, target = open_filesystem(archive)
            records = _Records()
            try:
                with filesystem.open_input_file(target) as raw, zipfile.ZipFile(raw) as bundle, bundle.open(f"{table}.txt") as member:
                    data = member.read(_BLOCK_BYTES).removeprefix(b"\xef\xbb\xbf")
                    while data is not None:
                        after = member.read(_BLOCK_BYTES) or None
                        if (found := records.block(data, after is None)) is not None:
                            yield row(archive, table, found[0], records.header, found[1], None)
                        data = after
            except OSError:
                raise  # storage trouble is not a bad table: let Spark run the task again
            except Exception as error:  # noqa: BLE001 - a bad table is reported, the others are read
                yield row(archive, table, None, None, None, str(error) or type(error).__name__)


def _parsed_blocks(blocks: DataFrame) -> DataFrame:
    """(archive, table, line_no, row) of record blocks, parsed by the JVM."""
    width = blocks.agg(F.max(F.size("header"))).first()[0] or 1
    cells = ", ".join(f"c{i} STRING" for i in range(width))
    spread = blocks.select("archive", "table", "first", "header", F.posexplode("records").alias("at", "record"))
    # The line end goes first: it is no part of the last field.
    record = F.regexp_replace("record", r"\r?\n\z", "")
    parsed = F.from_csv(record, cells, {"quote": '"', "escape": '"', "multiLine": "true"})
    rows = spread.select("archive", "table", (F.col("first") + F.col("at")).alias("line_no"), "header", parsed.alias("cells"))
    # Of repeated column names the last one counts.
    places = F.filter(F.sequence(F.lit(1), F.size("header")), lambda i: ~F.array_contains(F.slice("header", i + 1, F.size("header")), F.element_at("header", i)))
    values = F.array(*[f"cells.c{i}" for i in range(width)])
    pick = lambda array: F.transform(places, lambda i: F.element_at(array, i))
    return rows.select("archive", "table", "line_no", F.map_from_arrays(pick(F.col("header")), pick(values)).alias("row"))


def read_static_bundles(spark: SparkSession, base: str, pattern: str = "*.zip", tables: Sequence[str] = STATIC_TABLES) -> DataFrame:
    """(archive, table, line_no, row, problem): the rows of the wanted schedule tables of each bundle.

    Tables are found in the bundles' directories; others are never opened. A wanted table is inflated
    once, by one task, since a deflated file has no random access, into blocks of whole records that
    wait in the shared folder and are parsed side by side, whatever the size of the table. Empty
    fields are null, blank lines don't count, of repeated column names the last counts. A table that
    cannot be read to its end, or has a record wider than its header, gives no rows and is reported
    once in ``problem``; so is a broken bundle, without a table.
    """
    wanted = tuple(tables)
    named = list_files(spark, base, pattern).select("path").mapInPandas(lambda batches: _tables_of(batches, wanted), "archive STRING, table STRING, problem STRING")
    spread = named.repartition(4 * spark.sparkContext.defaultParallelism, "archive", "table")
    blocks = spread.mapInArrow(_table_blocks, _BLOCKS)
    waiting = fresh_dir(spark, "bundle-blocks")
    blocks.repartition(4 * spark.sparkContext.defaultParallelism, "archive", "table", "first").write.option("compression", "zstd").parquet(waiting)
    blocks = spark.read.schema(_BLOCKS).parquet(waiting)
    problems = blocks.where("problem is not null").select("archive", "table", "problem")
    bad = problems.where("table is not null").select("archive", "table")
    good = blocks.where("problem is null").join(bad, ["archive", "table"], "left_anti")
    return _parsed_blocks(good).unionByName(problems, allowMissingColumns=True)


def good_rows(rows: DataFrame) -> DataFrame:
    return rows.where("problem is null").drop("problem")


def static_table(rows: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """One schedule table with the named columns, all text; an absent column is null."""
    picked = rows.where(F.col("table") == table)
    return picked.select("archive", *[F.try_element_at("row", F.lit(c)).alias(c) for c in columns])


def read_static_json(spark: SparkSession, base: str) -> DataFrame:
    """(feed_name, stamp, table, row) of stored schedule documents."""
    documents = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "gtfs_static_*.json")
        .schema(STATIC_DOCUMENT)
        .option("multiLine", True)
        .json(base)
    )
    tables = documents.select("feed_name", F.col("timestamp").alias("stamp"), F.explode("tables").alias("table", "rows"))
    rows = tables.select("feed_name", "stamp", "table", F.explode("rows").alias("row"))
    # A missing value was written as a bare NaN.
    return rows.withColumn("row", F.transform_values("row", lambda _, v: F.nullif(v, F.lit("NaN"))))
