"""Packing: overlong documents are cut into full windows, the rest goes best-fit decreasing."""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Callable, Iterator, Sequence
from functools import cached_property, lru_cache
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import ranked, staged, text_batches

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_CACHED_WORDS, _CACHED_LENGTH = 250_000, 48


#: Fixed value: how byte-level BPE cuts text into the pieces that it encodes one by one.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: A blank inside or at the end of white space that began before it: no piece starts there.
_INNER_BLANK = re.compile(r" (?!\S)(?<=\s )")


def _byte_ranks(model: dict) -> dict[bytes, int]:
    """A byte-level vocabulary as ranks of byte strings. Its file writes bytes that don't print as
    the characters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    return {bytes(byte_of[c] for c in token): rank for token, rank in model["vocab"].items()}


def text_encoder(path: str, added_tokens: bool = False) -> Callable[[str], Sequence[int]]:
    """Ids of a text under a tokenizer file. ``added_tokens``: strings of the file's added tokens get
    the ids of those, as in ``Tokenizer.encode``; otherwise strings of special tokens are ordinary text.

    Plain byte-level BPE, whose merges come in order of their ids, runs on the faster of two
    libraries, with equal ids for texts without added tokens; any other file on the general one.
    """
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    cut = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    model, cutter = parts["model"], parts["pre_tokenizer"] or {}
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model.get("merges", [])]
    ids = [model["vocab"].get(m, -1) for m in merged]
    if model["type"] == "BPE" and not parts["normalizer"] and cut.items() <= cutter.items() and ids == sorted(ids):
        import tiktoken

        return tiktoken.Encoding("file", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=_byte_ranks(model), special_tokens={}).encode_ordinary
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = not added_tokens
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


class _Words(dict):
    """Token ids (little-endian unsigned 32-bit) of words; keeps the first ones, a bounded number."""

    def __init__(self, path: str, added_tokens: bool = False):
        super().__init__()
        self.path = path
        self.ids = text_encoder(path, added_tokens)
        self.splits = getattr(self.ids, "__name__", "") == "encode_ordinary"
        self.markers: list[str] = []
        if added_tokens and self.splits:
            with open(path, encoding="utf-8") as file:
                self.markers = [t["content"] for t in json.load(file).get("added_tokens") or []]

    @cached_property
    def general(self):
        """The tokenizer itself, for texts with added tokens; loaded when the first one comes."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def encode(self, text: str) -> bytes:
        marked = any(m in text for m in self.markers)
        ids = self.general.encode(text, add_special_tokens=False).ids if marked else self.ids(text)
        return array("I", ids).tobytes() if sys.byteorder == "little" else b"".join(i.to_bytes(4, "little") for i in ids)

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word)
        if len(word) <= _CACHED_LENGTH and len(self) < _CACHED_WORDS:
            self[word] = ids
        return ids


@lru_cache(maxsize=1)
def _words(path: str, added_tokens: bool = False) -> _Words:
    """One cache for all tasks of a Python worker."""
    return _Words(path, added_tokens)


def _text_ids(text: str, words: _Words) -> bytes:
    """Ids of a whole text. The byte-level pattern starts a piece at each blank that begins or ends
    a run of white space, so a text with no other blanks is the sum of its blank-led words; texts
    with blanks inside such runs (as between NBSP) or with added tokens are encoded whole. That holds
    for the byte-level pattern only, so ``words.splits`` says whether to."""
    if not text:
        return b""
    if "  " in text or not words.splits or _INNER_BLANK.search(text) or any(m in text for m in words.markers):
        return words.encode(text)
    first, *others = text.split(" ")
    return words[first] + b"".join([words[" " + w] for w in others])


def tokenized_pieces(docs: DataFrame, tokenizer: str, window: int, end_id: int, added_tokens: bool = False) -> DataFrame:
    """One row per piece: full windows from the start of each document, then what is left."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = _words(tokenizer, added_tokens), end_id.to_bytes(4, "little")
        names = [n.split()[0] for n in _PIECES.split(", ")]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = _text_ids(text.as_py(), words) + end
                total = len(ids) // 4
                for start in range(0, total, window):
                    piece = ids[4 * start : 4 * (start + window)]
                    for column, value in zip(out, (doc_id, start, len(piece) // 4, crc32(piece), total)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)

    slim = docs.select(docs["doc_id"].cast("long"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    return slim.mapInArrow(cut, _PIECES)


class _Tightest:
    """Segment tree over remaining capacities: the smallest that is open and large enough."""

    def __init__(self, window: int):
        self.base = 1 << window.bit_length()
        self.open = [0] * (2 * self.base)

    def add(self, capacity: int, bins: int) -> None:
        node = self.base + capacity
        while node:
            self.open[node] += bins
            node //= 2

    def at_least(self, need: int) -> int | None:
        node = self.base + need
        if self.open[node]:
            return need
        while node > 1 and (node % 2 or not self.open[node + 1]):
            node //= 2
        if node <= 1:
            return None
        node += 1
        while node < self.base:
            node = 2 * node if self.open[2 * node] else 2 * node + 1
        return node - self.base


def best_fit_decreasing(counts: dict[int, int], window: int) -> list[tuple[int, int, int, int, int, int]]:
    """Pack counts[length] pieces, longest first, each into the tightest open window.

    Pieces of one length are alike, so runs of windows in the same state are handled together; the
    outcome is that of one piece after another. Returns rows (length, first, pieces, sequence,
    offset, each): pieces ranked from ``first`` on go to sequences from ``sequence`` on, ``each`` to a
    sequence, the first of them at ``offset``. At most window lengths come in, whatever the table.
    """
    tree, runs, rows, fresh = _Tightest(window), {}, [], 0
    for length in sorted(counts, reverse=True):
        first, left = 0, counts[length]
        while left:
            room = tree.at_least(length)
            if room is None:
                bins, each, at, used = -(-left // (window // length)), window // length, fresh, 0
                fresh += bins
                spare = bins * each - left  # the last window may hold fewer
            else:
                at, bins = runs[room].pop()
                tree.add(room, -bins)
                each, used, spare = room // length, window - room, 0
                if bins * each > left:
                    take = -(-left // each)
                    if take < bins:
                        runs[room].append((at + take, bins - take))
                        tree.add(room, bins - take)
                    bins = take
                    spare = bins * each - left
            placed = bins * each - spare
            rows.append((length, first, placed, at, used, each))
            last = each - spare  # pieces in the last window
            for start, n, k in ((at, bins - (spare > 0), each), (at + bins - 1, int(spare > 0), last)):
                rest = window - used - k * length
                if n:
                    runs.setdefault(rest, []).append((start, n))
                    tree.add(rest, n)
            first, left = first + placed, left - placed
    return rows


def pack_documents(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1, added_tokens: bool = False) -> DataFrame:
    """Pack documents (doc_id, text) into sequences of at most ``window`` tokens.

    Returns per piece doc_id, start, length, ids_crc32 (ids as little-endian unsigned 32 bits),
    doc_tokens, sequence_id and offset; :func:`padding` tells what each sequence is padded to. Every document ends in ``end_id``; null or empty texts are
    that id alone. Only counts per length (at most ``window``) reach the driver; ranks within a
    length spread over tasks, so copies and hot lengths are harmless. No documents, no rows; other
    columns are not read. ``added_tokens`` takes strings of the tokenizer's added tokens as these
    tokens (see :func:`text_encoder`).
    """
    spark: SparkSession = docs.sparkSession
    text_batches(spark)
    pieces = staged(tokenized_pieces(docs, tokenizer, window, end_id, added_tokens), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = best_fit_decreasing(counts, window)
    schema = "length long, first long, pieces long, sequence long, used long, each long"
    ranges = spark.createDataFrame(plan, schema)
    placed = ranked(pieces, ["length"], ["doc_id", "start"]).join(ranges, "length")
    inside = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("pieces"))
    turn = F.col("rank") - F.col("first")
    return placed.where(inside).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("sequence") + F.expr("(rank - first) div each")).alias("sequence_id"),
        (F.col("used") + F.col("length") * (turn % F.col("each"))).alias("offset"),
    )


def padding(packed: DataFrame, window: int = 2048) -> DataFrame:
    """Per sequence: sequence_id, used and padded tokens (``window``; a power of two stays as it is)."""
    used = packed.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    power = F.col("used").bitwiseAND(F.col("used") - 1) == 0
    return used.withColumn("padded", F.when(power, F.col("used")).otherwise(F.lit(window)))
