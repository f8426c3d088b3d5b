"""Suffixes that can hold a repeated string: choice, sorted front-coded runs, merging by loser tree."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from feedloom.llm.wordhash import range_hashes

#: Bytes hashed to choose anchors.
GRAM = 16
#: Suffixes of one anchor are cut into those whose start lies 0-7 and 8 or more bytes before it.
LEVELS = (0, 8)


@dataclass(frozen=True)
class Shape:
    """Every string of ``length`` bytes holds, among its first ``reach`` grams, one of least hash."""

    length: int

    @property
    def reach(self) -> int:
        return max(1, min(self.length - GRAM + 1, self.length * 3 // 4))

    @property
    def context(self) -> int:
        """Bytes from an anchor on that all its strings hold."""
        return self.length - self.reach + 1

    def level_bounds(self) -> list[tuple[int, int]]:
        """(first, last) distance from start to anchor per level."""
        lows = [x for x in LEVELS if x < self.reach]
        return [(low, high - 1) for low, high in zip(lows, [*lows[1:], self.reach])]

    def common(self, level: int) -> int:
        """Bytes from the level's nearest start on that all strings of the level hold."""
        low, high = self.level_bounds()[level]
        return self.length - (high - low)


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of values[i : i + width] for every full window."""
    span, out = 1, values
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, offsets: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, first, last): the string starts first..last of a row share an anchor.

    The anchor is the leftmost gram of least hash among the first ``reach`` of the string, so equal
    strings have it at the same place. Rows shorter than the length have none.
    """
    none = np.zeros(0, np.int64)
    if len(data) < shape.length:
        return none, none, none, none
    at = np.arange(len(data) - GRAM + 1)
    keys = (range_hashes(data, at, at + GRAM) & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    chosen = (_sliding_minimum(keys, shape.reach) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    sizes = np.maximum(0, np.diff(offsets) - shape.length + 1)
    starts = np.repeat(offsets[:-1] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    if not len(starts):
        return none, none, none, none
    anchor = chosen[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    row = np.searchsorted(offsets, starts[first], "right") - 1
    return row, anchor[first], starts[first], starts[last]


def level_suffixes(anchor: np.ndarray, first: np.ndarray, last: np.ndarray, shape: Shape) -> tuple[np.ndarray, ...]:
    """(index, level, at, first, last): each anchor's starts cut by level; the suffix begins at ``at``."""
    out = []
    for level, (low, high) in enumerate(shape.level_bounds()):
        f, e = np.maximum(first, anchor - high), np.minimum(last, anchor - low)
        some = np.flatnonzero(f <= e)
        out.append((some, np.full(len(some), level), anchor[some] - low, f[some], e[some]))
    return tuple(np.concatenate(x) for x in zip(*out))


def front_code(entries: list[tuple[bytes, bytes, bool, list[int]]]) -> bytes:
    """A run of (body, left, many, owners) sorted by body and left, as compressed bytes.

    body: the level's byte and the suffix, stored without what it shares with the one before; left:
    what earlier starts have in front; many: occurs more than once in the run; owners: its rows in
    the run's table of documents.
    """
    shared, tails, lefts = np.zeros(len(entries), np.uint16), [], []
    before = b""
    for i, (body, left, _, _) in enumerate(entries):
        shared[i] = common_prefix(before, body, 0)
        tails.append(body[shared[i] :])
        lefts.append(left)
        before = body
    lengths = np.array([len(t) for t in tails], np.uint16), np.array([len(x) for x in lefts], np.uint16)
    many = np.array([e[2] for e in entries], np.uint8)
    owners = np.array([o for e in entries for o in e[3]], np.uint32)
    owned = np.array([len(e[3]) for e in entries], np.uint32)
    parts = [shared.tobytes(), lengths[0].tobytes(), lengths[1].tobytes(), many.tobytes(), owned.tobytes(), owners.tobytes(), b"".join(tails), b"".join(lefts)]
    head = np.array([len(entries), *map(len, parts)], np.int64).tobytes()
    return pack(head + b"".join(parts))


def decode_run(blob: bytes) -> Iterator[tuple[bytes, int, bytes, bool, np.ndarray]]:
    """(body, prefix shared with the one before, left, many, owners) in order."""
    raw = unpack(blob)
    n, *sizes = np.frombuffer(raw, np.int64, 9)
    at, parts = 72, []
    for size in sizes:
        parts.append(raw[at : at + size])
        at += size
    shared, tail, left_size = (np.frombuffer(p, np.uint16).tolist() for p in parts[:3])
    many, owned = np.frombuffer(parts[3], np.uint8).tolist(), np.frombuffer(parts[4], np.uint32).tolist()
    owners = np.frombuffer(parts[5], np.uint32)
    t = x = o = 0
    body = b""
    for i in range(n):
        body = body[: shared[i]] + parts[6][t : t + tail[i]]
        left = parts[7][x : x + left_size[i]]
        yield body, shared[i], left, bool(many[i]), owners[o : o + owned[i]]
        t, x, o = t + tail[i], x + left_size[i], o + owned[i]


def pack(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(blob: bytes) -> bytes:
    return pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix; the first ``known`` bytes are known to agree."""
    end = min(len(a), len(b))
    while known < end:
        step = min(end - known, 32)
        if a[known : known + step] == b[known : known + step]:
            known += step
            continue
        x = int.from_bytes(a[known : known + step], "big") ^ int.from_bytes(b[known : known + step], "big")
        return known + step - 1 - (x.bit_length() - 1) // 8
    return end


def merge_runs(runs: list[Iterator[tuple[bytes, int, bytes, bool, np.ndarray]]]) -> Iterator[tuple[int, int, tuple]]:
    """(prefix shared with the last output, run, entry) over all runs in order of body.

    A loser tree of runs. Each waiting entry knows the prefix it shares with the last output of its
    node; of two entries the one that shares more comes first, and only when both share the same
    are bytes compared, from there on. So no byte of a known prefix is looked at again.
    """
    k = 1 << max(0, len(runs) - 1).bit_length()
    heads: list[tuple | None] = [next(r, None) for r in runs] + [None] * (k - len(runs))
    shared = [0] * k
    losers = [-1] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's shared prefix becomes that with the winner."""
        x, y = heads[a], heads[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        both = common_prefix(x[0], y[0], shared[a])
        if x[0][both : both + 1] <= y[0][both : both + 1]:
            shared[b] = both
            return a, b
        shared[a] = both
        return b, a

    def build(node: int) -> int:
        if node >= k:
            return node - k
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1) if k > 1 else 0
    while heads[winner] is not None:
        yield shared[winner], winner, heads[winner]
        following = next(runs[winner], None)
        heads[winner] = following
        shared[winner] = following[1] if following is not None else 0
        node = (winner + k) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2
