"""Lines that many documents share: range-partitioned hashes, streamed in order, bitmaps of what stays."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from feedloom.llm.common import text_batches
from feedloom.session import shared_dir

_BLANKS = " \t\n\x0b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_DROPPED = "k1 long, k2 int, pos int"


def _named(docs: DataFrame) -> DataFrame:
    """(doc_id, k1, k2, text): rows equal in doc_id and text have equal keys; a null text is empty."""
    text, doc_id = F.coalesce(docs["text"], F.lit("")), docs["doc_id"]
    return docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, text).alias("k1"), F.hash(text, doc_id).alias("k2"), text.alias("text"))


def line_key(line: Column) -> Column:
    """The line without white space (space, tab to carriage return) at both ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(_BLANKS)), _UPPER, _LOWER)


def _line_table(named: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, doc_id, k1, k2, pos, n): 128 bits of each line's key, and how many equal rows have it there."""
    lines = named.select("doc_id", "k1", "k2", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keyed = lines.select("doc_id", "k1", "k2", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    hashed = keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(12), "key").alias("h2"), "doc_id", "k1", "k2", "pos")
    return hashed.groupBy(*hashed.columns).agg(F.count("*").alias("n"))


class _Batch:
    """Columns of a sorted batch with the places where a key, or a document within a key, begins."""

    def __init__(self, batch: pa.RecordBatch, last: tuple | None):
        self.h1, self.h2, self.k1, self.k2, self.pos, self.n = (batch.column(c).to_numpy() for c in ("h1", "h2", "k1", "k2", "pos", "n"))
        rows = len(self.n)
        self.key, self.doc = np.ones(rows, bool), np.ones(rows, bool)
        self.key[1:] = (self.h1[1:] != self.h1[:-1]) | (self.h2[1:] != self.h2[:-1])
        self.doc[1:] = self.key[1:] | (self.k1[1:] != self.k1[:-1]) | (self.k2[1:] != self.k2[:-1])
        self.goes_on = last is not None and last[:2] == (self.h1[0], self.h2[0])
        self.key[0] = not self.goes_on
        self.doc[0] = last is None or last != (self.h1[0], self.h2[0], self.k1[0], self.k2[0])
        self.start = np.flatnonzero(self.key | (np.arange(rows) == 0))
        self.segment = np.cumsum(self.key) - int(self.key[0])
        #: Documents per key, by first occurrences: later lines of a document don't count.
        self.docs = np.add.reduceat(self.n * self.doc, self.start)
        self.last = (self.h1[-1], self.h2[-1], self.k1[-1], self.k2[-1])

    def key_of(self, segment: int) -> tuple[int, int]:
        return int(self.h1[self.start[segment]]), int(self.h2[self.start[segment]])


def _edge_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of the first and the last key of a slice: all that other slices may hold more of."""
    first, now, docs, last, place = None, None, 0, None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        place = batch.column("slice")[0].as_py()
        part = _Batch(batch, last)
        last = part.last
        for segment in sorted({0, len(part.docs) - 1}):
            if segment == 0 and part.goes_on:
                docs += int(part.docs[0])
                continue
            if first is None and now is not None:
                first = (*now, docs)
            now, docs = part.key_of(segment), int(part.docs[segment])
    ends = [x for x in (first, None if now is None else (*now, docs)) if x is not None]
    names = ["slice", "h1", "h2", "docs"]
    yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*[(place, *e) for e in ends])] or [pa.array([], pa.int64())] * 4, names)


def _dropper(shared: dict[tuple[int, int], tuple[int, int]], min_docs: int, keep_first: bool):
    """Stream a slice and name the lines that go. ``shared`` has (documents, first slice) of keys in several slices."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, docs = None, 0
        held: list[pa.RecordBatch] = []  # lines of the open key while it has fewer than min_docs documents
        for batch in batches:
            if not batch.num_rows:
                continue
            part, place = _Batch(batch, last), batch.column("slice")[0].as_py()
            last, end = part.last, len(part.docs) - 1
            counts = part.docs.copy()
            counts[0] += docs if part.goes_on else 0
            known = {s: shared[key] for s in {0, end} if (key := part.key_of(s)) in shared}
            gone = counts >= min_docs
            stays = part.key.copy() if keep_first else np.zeros(len(part.key), bool)
            for segment, (total, first_slice) in known.items():
                gone[segment] = total >= min_docs
                stays[part.start[segment]] &= first_slice == place
            rows = pa.RecordBatch.from_arrays([pa.array(x) for x in (part.k1, part.k2, part.pos)], ["k1", "k2", "pos"])
            take = gone[part.segment] & ~stays
            if not part.goes_on:
                held = []
            if gone[0]:
                yield from held
                held = []
            if take.any():
                yield rows.filter(pa.array(take))
            if not gone[end]:
                held = held if end == 0 else []
                if end not in known:
                    held.append(rows.filter(pa.array((part.segment == end) & ~stays)))
            else:
                held = []
            docs = int(counts[end])

    return stream


@F.pandas_udf(BinaryType())
def _bitmap(positions: pd.Series) -> pd.Series:
    def packed(gone: np.ndarray) -> bytes:
        bits = np.ones((int(gone.max()) // 8 + 1) * 8, np.uint8)
        bits[gone] = 0
        return zlib.compress(np.packbits(bits, bitorder="little").tobytes())

    return positions.map(packed)


def stays(bitmap: bytes, n_lines: int) -> np.ndarray:
    """Which of a document's lines a compressed bitmap keeps; lines beyond its end stay."""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), bitorder="little")[:n_lines].astype(bool)
    return np.concatenate([bits, np.ones(n_lines - len(bits), bool)])


def _bitmaps(named: DataFrame, min_docs: int, min_chars: int, keep_first: bool) -> DataFrame:
    shared_dir(named.sparkSession)
    order = ["h1", "h2", "doc_id", "k1", "k2"]
    laid = _line_table(named, min_chars).repartitionByRange(*order).sortWithinPartitions(*order, "pos")
    laid = laid.drop("doc_id").withColumn("slice", F.spark_partition_id()).checkpoint()
    edges = laid.mapInArrow(_edge_counts, "slice long, h1 long, h2 long, docs long").groupBy("h1", "h2")
    # At most two rows a slice.
    several = edges.agg(F.sum("docs").alias("docs"), F.min("slice").alias("first"), F.count("*").alias("slices")).where("slices > 1").collect()
    shared = {(r["h1"], r["h2"]): (r["docs"], r["first"]) for r in several}
    dropped = laid.mapInArrow(_dropper(shared, min_docs, keep_first), _DROPPED)
    found = dropped.groupBy("k1", "k2").agg(F.collect_list("pos").alias("gone"))
    return found.select("k1", "k2", F.size("gone").cast("long").alias("n_dropped"), _bitmap("gone").alias("keep_bitmap"))


def line_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """``docs`` (doc_id, text, …) without text, with ``n_dropped`` and ``keep_bitmap``.

    A line of at least ``min_chars`` code points (see :func:`line_key`) goes where ``min_docs``
    documents hold its key: everywhere, or with ``keep_first`` everywhere but at its first place in
    order of (doc_id, digest of the text, line). The bitmap has one bit a line, least significant
    first, set for lines that stay, compressed by zlib; lines past its end stay; null: all stay.
    :func:`stays` reads it.

    Hashes of lines are dealt by range of (key, document), which cuts through keys of any size, and
    sorted by document and line. Tasks stream them: first occurrences count documents, and lines
    wait only while their key has fewer than ``min_docs``. A key cut by a slice's border gets its
    count from the borders of all slices. Only hashes and positions are exchanged, no text.

    Every row is a document, also rows of equal id or equal throughout (these share a bitmap, and
    with ``keep_first`` all of them keep the line). Null ids are ids like others, a null or empty
    text is one empty line, an empty table gives no rows, other columns pass through unread.
    Keys are compared by 128 bits of hash.
    """
    carried = docs.select(F.struct(*[c for c in docs.columns if c not in ("text", "n_dropped", "keep_bitmap")]).alias("row"), *_keys(docs))
    found = _bitmaps(_named(docs), min_docs, min_chars, keep_first)
    joined = carried.join(found, ["k1", "k2"], "left")
    return joined.select("row.*", F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), "keep_bitmap")


def _keys(docs: DataFrame) -> list[Column]:
    text = F.coalesce(docs["text"], F.lit(""))
    return [F.xxhash64(docs["doc_id"], text).alias("k1"), F.hash(text, docs["doc_id"]).alias("k2")]


@F.pandas_udf(StringType())
def _kept(text: pd.Series, bitmap: pd.Series) -> pd.Series:
    def one(value: str, bits: bytes) -> str:
        lines = value.split("\n")
        return "\n".join(compress(lines, stays(bits, len(lines))))

    return pd.Series([one(t, b) for t, b in zip(text, bitmap)], dtype=object)


def drop_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """``docs`` with ``text`` cut to the lines that stay (null becomes empty), ``n_lines`` and ``n_dropped``.

    The rule and its corner cases are those of :func:`line_bitmaps`. Texts meet their bitmaps in one
    exchange; only texts that lose lines pass through Python.
    """
    text_batches(docs.sparkSession)
    text = F.coalesce(docs["text"], F.lit(""))
    carried = docs.select(F.struct(*[(text if c == "text" else docs[c]).alias(c) for c in docs.columns]).alias("row"), *_keys(docs))
    joined = carried.join(_bitmaps(_named(docs), min_docs, min_chars, keep_first), ["k1", "k2"], "left")
    lines = F.size(F.split("row.text", "\n", -1)).cast("long")
    whole = joined.where("keep_bitmap is null").select("row", lines.alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"), F.col("row.text").alias("kept"))
    cut = joined.where("keep_bitmap is not null").select("row", lines.alias("n_lines"), "n_dropped", _kept("row.text", "keep_bitmap").alias("kept"))
    names = [F.col("kept").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return whole.unionByName(cut).select(*names, "n_lines", "n_dropped")


def line_digest(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of :func:`drop_common_lines`."""
    kept = drop_common_lines(docs.select("doc_id", "text"), min_docs, min_chars)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
