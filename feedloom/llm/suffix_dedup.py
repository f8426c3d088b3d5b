"""Exact removal of long repeated strings by a distributed merge sort of suffixes."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import staged, tasks_for, text_batches
from feedloom.llm.suffixes import Shape, anchors, decode_run, front_code, level_suffixes, merge_runs, pack, unpack
from feedloom.llm.wordhash import mix, range_hashes, text_chunks

_RUN_ANCHORS, _RUN_SUFFIXES = 1_000_000, 100_000  # a run is written when it holds so many
_SPLITTER_BYTES, _SAMPLE = 32, 4096


def _named(docs: DataFrame) -> DataFrame:
    """(k1, k2, text): equal (doc_id, text) rows have equal keys; a null text is empty."""
    text, doc_id = F.coalesce(docs["text"], F.lit("")), docs["doc_id"]
    return docs.select(F.xxhash64(doc_id, text).alias("k1"), F.hash(text, doc_id).alias("k2"), text.alias("text"))


def _columns(values: np.ndarray) -> bytes:
    """Numbers byte by byte, all first bytes first: small ones compress well."""
    return pack(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes())


def _numbers(blob: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(unpack(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


_SKETCH = "kind int, part int, run long, place long, data binary, more binary"


def _sketches(docs: DataFrame, shape: Shape, parts: int) -> DataFrame:
    """Per task: sorted hashes of what follows each anchor, dealt by hash range (kind 0); which
    document holds which (kind 1); some suffix beginnings to choose splitters from (kind 2)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, sequence = TaskContext.get().partitionId(), 0
        hashes, counts, keys, sample, held = [], [], [], [], 0

        def written() -> pa.RecordBatch:
            run = (task << 24) + sequence
            all_hashes = np.concatenate(hashes) >> np.uint64(16)
            values, place, many = np.unique(all_hashes, return_inverse=True, return_counts=True)
            part = ((values * np.uint64(parts)) >> np.uint64(48)).astype(np.int64)
            edges = np.searchsorted(part, np.arange(parts + 1))
            rows = [(1, -1, run, len(values), _columns(place.astype(np.uint32)), pack(np.concatenate(counts).astype(np.uint32).tobytes() + b"".join(keys)))]
            for p in np.flatnonzero(np.diff(edges)):
                s, e = edges[p], edges[p + 1]
                rows.append((0, int(p), run, int(s), _columns(np.diff(values[s:e], prepend=np.uint64(0))), np.packbits(many[s:e] > 1).tobytes()))
            rows += [(2, -1, run, 0, x, b"") for x in sample[:: max(1, len(sample) // 64)][:64]]
            names = [n.split()[0] for n in _SKETCH.split(", ")]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for top, data, offsets in text_chunks(batch.column(2)):
                row, anchor, first, last = anchors(data, offsets, shape)
                n = len(offsets) - 1
                hashes.append(range_hashes(data, anchor, anchor + shape.context))
                counts.append(np.bincount(row, minlength=n))
                pairs = np.zeros(n, [("k1", np.int64), ("k2", np.int32)])
                pairs["k1"], pairs["k2"] = k1[top : top + n], k2[top : top + n]
                keys.append(pairs.tobytes())
                some = level_suffixes(anchor[::97], first[::97], last[::97], shape)
                wide = min(_SPLITTER_BYTES, min(map(shape.common, range(len(shape.level_bounds())))))
                sample += [bytes([v]) + data[a : a + wide].tobytes() for v, a in zip(some[1], some[2])]
                held += len(anchor)
                if held >= _RUN_ANCHORS:
                    yield written()
                    sequence, held = sequence + 1, 0
                    hashes, counts, keys, sample = [], [], [], []
        if held:
            yield written()

    return docs.mapInArrow(scan, _SKETCH)


def _seen_twice(frame: pd.DataFrame) -> pd.DataFrame:
    """Which hashes of each run occur anywhere else; one hash range, each hash once per run."""
    lists = [np.cumsum(_numbers(b, np.uint64), dtype=np.uint64) for b in frame["data"]]
    order = np.concatenate(lists) if lists else np.zeros(0, np.uint64)
    _, place, runs = np.unique(order, return_inverse=True, return_counts=True)
    twice, at, out = runs[place] > 1, 0, []
    for values, many in zip(lists, frame["more"]):
        own = np.unpackbits(np.frombuffer(many, np.uint8), count=len(values)).astype(bool)
        flags = twice[at : at + len(values)] | own
        at += len(values)
        out.append(np.packbits(flags).tobytes() + len(values).to_bytes(8, "little"))
    return pd.DataFrame({"run": frame["run"], "place": frame["place"], "flags": out})


def _marked(tables: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
    """(k1, k2, bits, n): a bit per anchor of each document of a run; documents without any left out."""
    out: list[tuple] = []
    for total, places, more in zip(tables["place"], tables["data"], tables["more"]):
        flags = np.zeros(total, bool)
        for at, reply in zip(replies["place"], replies["flags"]):
            n = int.from_bytes(reply[-8:], "little")
            flags[at : at + n] = np.unpackbits(np.frombuffer(reply[:-8], np.uint8), count=n)
        marks, raw = flags[_numbers(places, np.uint32)], unpack(more)
        docs = len(raw) // 16
        ends = np.cumsum(np.frombuffer(raw[: 4 * docs], np.uint32).astype(np.int64))
        keys = np.frombuffer(raw[4 * docs :], [("k1", np.int64), ("k2", np.int32)])
        sums = np.concatenate([[0], np.cumsum(marks)])
        starts = np.concatenate([[0], ends[:-1]])
        n = sums[ends] - sums[starts]
        out += [(int(keys["k1"][i]), int(keys["k2"][i]), np.packbits(marks[starts[i] : ends[i]]).tobytes(), int(n[i])) for i in np.flatnonzero(n)]
    return pd.DataFrame(out, columns=["k1", "k2", "bits", "n"])


_OWNER = np.dtype([("k1", np.int64), ("k2", np.int32), ("first", np.int32)])


def _runs(marked: DataFrame, shape: Shape, splitters: list[bytes]) -> DataFrame:
    """(part, run, owners): sorted front-coded runs of the marked suffixes, cut at the splitters."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[bytes, bytes], list[int]] = {}
        owners: list[np.ndarray] = []
        owned = 0

        def written() -> pa.RecordBatch:
            table = np.concatenate(owners)
            entries = sorted(held.items())
            bodies = [e[0][0] for e in entries]
            edges = [0, *(bisect_right(bodies, s) for s in splitters), len(entries)]
            rows = []
            for part, (s, e) in enumerate(zip(edges, edges[1:])):
                if e > s:
                    mine = [i for _, own in entries[s:e] for i in own]
                    at = iter(range(len(mine)))
                    coded = front_code([(b, x, len(own) > 1, [next(at) for _ in own]) for (b, x), own in entries[s:e]])
                    rows.append((part, coded, pack(table[mine].tobytes())))
            columns = [pa.array(list(c), k) for c, k in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))]
            return pa.RecordBatch.from_arrays(columns, ["part", "run", "owners"])

        for batch in batches:
            k1, k2, bits = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(3)
            for top, data, offsets in text_chunks(batch.column(2)):
                row, anchor, first, last = anchors(data, offsets, shape)
                n = len(offsets) - 1
                sizes = np.bincount(row, minlength=n)
                marks = [np.unpackbits(np.frombuffer(bits[top + i].as_py(), np.uint8), count=sizes[i]) for i in range(n)]
                some = np.flatnonzero(np.concatenate(marks)) if n else np.zeros(0, np.int64)
                index, level, at, first, last = level_suffixes(anchor[some], first[some], last[some], shape)
                row = row[some][index]
                table = np.zeros(len(row), _OWNER)
                table["k1"], table["k2"], table["first"] = k1[top + row], k2[top + row], first - offsets[row]
                owners.append(table)
                raw = data.tobytes()
                for v, a, f, e in zip(level.tolist(), at.tolist(), first.tolist(), (last + shape.length).tolist()):
                    held.setdefault((b"\0\1"[v : v + 1] + raw[a:e], raw[f:a]), []).append(owned)
                    owned += 1
                if owned >= _RUN_SUFFIXES:
                    yield written()
                    held, owners, owned = {}, [], 0
        if held:
            yield written()

    return marked.mapInArrow(sort, "part int, run binary, owners binary")


class _Repeats:
    """Takes the merged suffixes of a part and finds which string starts repeat."""

    def __init__(self, shape: Shape, tables: list[np.ndarray]):
        self.shape, self.tables = shape, tables
        self.found: list[np.ndarray] = []
        self.texts: list[bytes] = []
        self.groups: list[int] = []
        self.many: list[bool] = []
        self.owners: list[tuple[int, np.ndarray]] = []
        self.held = 0

    def add(self, group: list[tuple[int, tuple]], number: int) -> None:
        if len(group) == 1 and not group[0][1][3]:
            return
        for run, (body, _, left, many, owners) in group:
            self.texts.append(left + body[1:])
            self.groups.append(number)
            self.many.append(many)
            self.owners.append((run, owners))
            self.held += len(self.texts[-1])

    def flush(self) -> None:
        """All starts of the waiting groups at once: those whose string occurs twice in its group."""
        if not self.texts:
            return
        n = self.shape.length
        data = np.frombuffer(b"".join(self.texts), np.uint8)
        sizes = np.array([len(t) for t in self.texts])
        begins = np.cumsum(sizes) - sizes
        counts = sizes - n + 1
        entry = np.repeat(np.arange(len(sizes)), counts)
        place = np.arange(len(entry)) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = begins[entry] + place
        many = np.array(self.many)
        keys = mix(range_hashes(data, starts, starts + n) ^ mix(np.array(self.groups, np.uint64))[entry])
        order = np.argsort(keys, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = keys[order[1:]] != keys[order[:-1]]
        bin_of = np.cumsum(new) - 1
        total = np.bincount(bin_of, np.where(many[entry[order]], 2, 1))
        again = np.zeros(len(order), bool)
        again[order] = total[bin_of] > 1
        edge = again & np.concatenate([[True], ~again[:-1] | (entry[1:] != entry[:-1])])
        stop = again & np.concatenate([~again[1:] | (entry[1:] != entry[:-1]), [True]])
        e, low, high = entry[edge], place[edge], place[stop] + n
        owned = [self.tables[self.owners[i][0]][self.owners[i][1]] for i in e]
        if owned:
            each = np.array([len(o) for o in owned])
            rows = np.zeros(each.sum(), [("k1", np.int64), ("k2", np.int32), ("start", np.int64), ("end", np.int64)])
            table = np.concatenate(owned)
            rows["k1"], rows["k2"] = table["k1"], table["k2"]
            rows["start"], rows["end"] = table["first"] + np.repeat(low, each), table["first"] + np.repeat(high, each)
            self.found.append(rows)
        self.texts, self.groups, self.many, self.owners, self.held = [], [], [], [], 0


def joined_spans(starts: np.ndarray, ends: np.ndarray, owner: np.ndarray | None = None) -> np.ndarray:
    """Indices (first, last) of spans, sorted by owner and start, that overlap or touch."""
    owner = np.zeros(len(starts), np.int64) if owner is None else owner
    wide = int(ends.max(initial=0)) + 1
    reach = np.maximum.accumulate(ends + owner * wide)
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] + owner[1:] * wide > reach[:-1]
    new[1:] |= owner[1:] != owner[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return np.stack([first, last, reach[last] - owner[last] * wide])


def _merger(shape: Shape):
    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        tables = [np.frombuffer(unpack(b), _OWNER) for b in frame["owners"]]
        repeats, group, number = _Repeats(shape, tables), [], 0
        for shared, run, entry in merge_runs([decode_run(b) for b in frame["run"]]):
            if group and shared < 1 + shape.common(group[-1][1][0][0]):
                repeats.add(group, number)
                group, number = [], number + 1
                if repeats.held > 1 << 19:
                    repeats.flush()
            group.append((run, entry))
        repeats.add(group, number)
        repeats.flush()
        if not repeats.found:
            return pd.DataFrame({"k1": [], "k2": [], "spans": []})
        rows = np.concatenate(repeats.found)
        rows = rows[np.lexsort((rows["start"], rows["k2"], rows["k1"]))]
        new = np.ones(len(rows), bool)
        new[1:] = (rows["k1"][1:] != rows["k1"][:-1]) | (rows["k2"][1:] != rows["k2"][:-1])
        first, last, reach = joined_spans(rows["start"], rows["end"], np.cumsum(new) - 1)
        pairs = np.stack([rows["start"][first], reach], axis=1)
        top = np.append(np.flatnonzero(new[first]), len(first))
        spans = [pairs[s:e].tobytes() for s, e in zip(top[:-1], top[1:])]
        heads = first[top[:-1]]
        return pd.DataFrame({"k1": rows["k1"][heads], "k2": rows["k2"][heads], "spans": spans})

    return merge


def repeated_spans(docs: DataFrame, length: int = 200) -> DataFrame:
    """(k1, k2, spans): per document (keys of :func:`_named`) the byte spans, as pairs of 64-bit
    numbers in arrays from several tasks, covered by strings of ``length`` bytes that start twice.

    1. Every string start has an anchor, a gram of least hash inside the string. Tasks send sorted,
       delta-coded hashes of what follows their anchors; only suffixes at anchors whose hash occurs
       twice can matter, the rest never leaves its task.
    2. Tasks sort those suffixes into front-coded runs, cut at common splitters. A copy within a
       run, or within a hot passage, is one entry.
    3. Each range is merged by a loser tree that never compares known prefixes again. Suffixes that
       share what all strings of a level share are one group; within it a start repeats if its
       whole string does.
    """
    spark = docs.sparkSession
    text_batches(spark)
    shape, parts = Shape(length), tasks_for(spark)
    named = _named(docs)
    sketch = staged(_sketches(named, shape, parts), "sketch")
    replies = sketch.where("kind = 0").groupBy("part").applyInPandas(_seen_twice, "run long, place long, flags binary")
    tables = sketch.where("kind = 1")
    marks = tables.groupBy("run").cogroup(replies.groupBy("run")).applyInPandas(_marked, "k1 long, k2 int, bits binary, n long")
    marks = staged(marks, "marks")
    sample = sketch.where("kind = 2").select("data").orderBy(F.xxhash64("data"), "data").limit(_SAMPLE)
    beginnings = sorted({bytes(r[0]) for r in sample.collect()})
    total = marks.agg(F.sum("n")).first()[0] or 0
    wanted = max(parts, total * 300 // (16 << 20))
    splitters = [beginnings[len(beginnings) * i // wanted] for i in range(1, wanted)] if beginnings else []
    marked = named.join(marks.dropDuplicates(["k1", "k2"]), ["k1", "k2"]).select("k1", "k2", "text", "bits")
    runs = _runs(marked, shape, sorted(set(splitters)))
    spans = runs.repartition(len(set(splitters)) + 1, "part").groupBy("part").applyInPandas(_merger(shape), "k1 long, k2 int, spans binary")
    return staged(spans, "spans").groupBy("k1", "k2").agg(F.collect_list("spans").alias("spans"))


def _all_spans(parts: list[bytes] | None) -> np.ndarray:
    """Disjoint (start, end) rows of one document, in order."""
    if not parts:
        return np.zeros((0, 2), np.int64)
    pairs = np.frombuffer(b"".join(parts), np.int64).reshape(-1, 2)
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    first, _, reach = joined_spans(pairs[:, 0], pairs[:, 1])
    return np.stack([pairs[first, 0], reach], axis=1)


def _with_spans(docs: DataFrame, columns: list[Column], length: int) -> DataFrame:
    spans = repeated_spans(docs, length).withColumnsRenamed({"k1": "_k1", "k2": "_k2", "spans": "_spans"})
    text = F.coalesce(docs["text"], F.lit(""))
    keyed = docs.select(*columns, F.xxhash64(docs["doc_id"], text).alias("_k1"), F.hash(text, docs["doc_id"]).alias("_k2"), text.alias("_text"))
    return keyed.join(spans, ["_k1", "_k2"], "left").drop("_k1", "_k2")


def removal_digest(docs: DataFrame, length: int = 200) -> DataFrame:
    """What removal leaves of each document (doc_id, text), as UTF-8 bytes.

    Every byte covered by a ``length``-byte string that also starts elsewhere (any document, the
    same one included, overlaps too) goes; strings are judged on the input. Returns doc_id, n_bytes,
    n_removed, n_spans (maximal removed runs) and kept_sha256. A null text is empty and keeps
    nothing. Repeated rows are repeats of each other. No documents, no rows; other columns are not
    read.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, parts in zip(batch.column(1), batch.column(2)):
                data, spans = text.as_py().encode(), _all_spans(parts.as_py())
                kept = sha256()
                at = 0
                for start, end in spans.tolist():
                    kept.update(data[at:start])
                    at = end
                kept.update(data[at:])
                out.append((len(data), int((spans[:, 1] - spans[:, 0]).sum()), len(spans), kept.hexdigest()))
            columns = [pa.array(list(c), k) for c, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = _with_spans(docs, [docs["doc_id"].cast("long").alias("doc_id")], length).select("doc_id", "_text", "_spans")
    return rows.mapInArrow(digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """The documents with repeated strings cut from ``text``, other columns as they were.

    Cuts shrink to whole characters. Null texts stay null.
    """

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, parts in zip(texts, spans):
            if parts is None or not len(parts):
                out.append(text)
                continue
            data, at, kept = text.encode(), 0, []
            for start, end in _all_spans([bytes(p) for p in parts]).tolist():
                while start < end and data[start] & 0xC0 == 0x80:
                    start += 1
                while end > start and end < len(data) and data[end] & 0xC0 == 0x80:
                    end -= 1
                kept.append(data[at:start])
                at = end
            out.append(b"".join([*kept, data[at:]]).decode())
        return pd.Series(out)

    names = docs.columns
    rows = _with_spans(docs, [docs[c] for c in names], length)
    text = F.when(F.col("text").isNotNull(), cut("_text", "_spans"))
    return rows.withColumn("text", text).select(*names)
