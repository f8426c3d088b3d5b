"""Landing folders by date, ``base/YYYYMMDD/``, as a stream: only open dates are listed."""

from __future__ import annotations

import posixpath
import re
import time
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatch

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from feedloom.sources.files import open_filesystem
from feedloom.sources.snapshots import snapshot_glob

_DATE = re.compile(r"\d{8}")
_NANOS = 1_000_000_000
_READ_BYTES = 16 << 20


@dataclass(frozen=True)
class _File:
    mtime: int
    name: str
    path: str
    size: int


class DatedFolders(SimpleDataSourceStreamReader):
    """Paths of new files, oldest first. An offset knows, per open date, what has been taken:

    ``{"closed": last date that is done, "days": {date: {"upto": time, "names": [...]}}}``. Files
    changed up to ``upto`` are taken, of later ones those in ``names``. A file may show up as long as
    ``lateness`` seconds after its time of change (it is written under another name, then moved), so
    names are remembered that long. A date is closed, and its folder never listed again, once a folder
    ``grace_days`` dates later is there and nothing in it is left.
    """

    def __init__(self, options: dict):
        self.base, self.pattern = options["path"], options["pattern"]
        self.most = int(options.get("maxFiles", 10000))
        self.lateness = int(float(options.get("lateness", 600)) * _NANOS)
        self.grace_days = int(options.get("graceDays", 1))

    def initialOffset(self) -> dict:
        return {"closed": "", "days": {}}

    def _days(self, closed: str) -> list[str]:
        from pyarrow import fs

        filesystem, root = open_filesystem(self.base)
        infos = filesystem.get_file_info(fs.FileSelector(root, allow_not_found=True))
        names = [posixpath.basename(i.path) for i in infos if i.type == fs.FileType.Directory]
        return sorted(n for n in names if _DATE.fullmatch(n) and n > closed)

    def _files(self, day: str) -> list[_File]:
        from pyarrow import fs

        filesystem, root = open_filesystem(self.base)
        infos = filesystem.get_file_info(fs.FileSelector(posixpath.join(root, day), recursive=True, allow_not_found=True))
        found = ((posixpath.basename(i.path), i) for i in infos if i.type == fs.FileType.File)
        start = len(posixpath.join(root, day)) + 1
        scheme = self.base.rstrip("/") + "/" + day + "/"
        return sorted((_File(i.mtime_ns, i.path[start:], scheme + i.path[start:], i.size) for n, i in found if fnmatch(n, self.pattern)), key=lambda f: (f.mtime, f.name))

    @staticmethod
    def _taken(offset: dict, day: str, file: _File) -> bool:
        if day <= offset["closed"]:
            return True
        state = offset["days"].get(day)
        return state is not None and (file.mtime <= state["upto"] or file.name in state["names"])

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        days, room, out = self._days(start["closed"]), self.most, []
        listed, left = {}, {}
        for day in days:
            listed[day] = self._files(day)
            new = [f for f in listed[day] if not self._taken(start, day, f)]
            out += [(f.path, f.size) for f in new[:room]]
            left[day], room = new[room:], room - min(room, len(new))
        states = {day: self._state(start, day, listed[day], left[day]) for day in days}
        done = [d for i, d in enumerate(days) if len(days) - 1 - i >= self.grace_days and not left[d]]
        closed = start["closed"]
        for day in days:  # dates close in order
            if day not in done:
                break
            closed = day
        end = {"closed": closed, "days": {d: s for d, s in states.items() if d > closed and s is not None}}
        return iter(out), end

    def _state(self, start: dict, day: str, files: list[_File], left: list[_File]) -> dict | None:
        waiting = {f.name for f in left}
        taken = [f for f in files if f.name not in waiting]
        before = start["days"].get(day)
        if not taken:
            return before
        upto = max(f.mtime for f in taken) - self.lateness
        upto = min([upto, *(f.mtime - 1 for f in left)])
        upto = max(upto, before["upto"] if before else 0)
        return {"upto": upto, "names": sorted(f.name for f in taken if f.mtime > upto)}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        for day in self._days(start["closed"]):
            for f in self._files(day):
                if self._taken(end, day, f) and not self._taken(start, day, f):
                    yield f.path, f.size

    def commit(self, end: dict) -> None:
        pass


class DatedLanding(DataSource):
    """Stream of (path, size); contents are read by tasks (:func:`stream_dated_files`)."""

    @classmethod
    def name(cls) -> str:
        return "dated_landing"

    def schema(self) -> str:
        return "path STRING, size BIGINT"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return DatedFolders(self.options)


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["snapshot_filename", "path", "content"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()) for c in zip(*rows)], names)

    for batch in batches:
        rows, held = [], 0
        for path in batch.column("path").to_pylist():
            filesystem, target = open_filesystem(path)
            with filesystem.open_input_stream(target, compression=None) as source:
                text = source.read().decode("utf-8", "replace")
            rows.append((posixpath.basename(path), path, text))
            held += len(text)
            if held >= _READ_BYTES:
                yield batch_of(rows)
                rows, held = [], 0
        if rows:
            yield batch_of(rows)


def stream_dated_files(spark: SparkSession, base: str, feed_type: str, files_per_batch: int = 10000, lateness: float = 600, grace_days: int = 1) -> DataFrame:
    """(snapshot_filename, path, content) of snapshots below ``base/YYYYMMDD/`` as they land.

    The driver lists the open dates alone and passes on paths, at most ``files_per_batch`` a batch;
    tasks read the files. A file that comes to a date after it has closed is not taken.
    """
    spark.dataSource.register(DatedLanding)
    options = {"path": base, "pattern": snapshot_glob(feed_type), "maxFiles": files_per_batch, "lateness": lateness, "graceDays": grace_days}
    paths = spark.readStream.format("dated_landing").options(**options).load()
    spread = paths.repartition(2 * spark.sparkContext.defaultParallelism, "path")
    return spread.mapInArrow(_contents, "snapshot_filename STRING, path STRING, content STRING")
