"""Word and shingle hashes of Arrow text columns in numpy, some megabytes at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit words that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = _powers(_BASE, _STEP + 1), _powers(_INVERSE, _STEP + 1)


def text_chunks(column: pa.Array, most: int = 1 << 19) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets from 0) of runs of rows of about ``most`` bytes; nulls are empty.

    A text longer than that is a run of its own, whole.
    """
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    n = len(column)
    if not n:
        return
    ends = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    lengths = np.diff(ends)
    if column.null_count:
        lengths = np.where(np.asarray(column.is_null()), 0, lengths)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + most, "right")) - 1)
        last = min(last, n)
        offsets = np.concatenate([[0], np.cumsum(lengths[first:last])])
        part = data[ends[first] : ends[last]]
        if len(part) != offsets[-1]:  # a null row that holds bytes
            part = np.concatenate([data[ends[i] : ends[i] + lengths[i]] for i in range(first, last)])
        yield first, part, offsets
        first = last


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end] for ascending starts; equal bytes, equal hash."""
    sums = np.zeros(len(data) + 1, np.uint64)
    for at in range(0, len(data), _STEP):  # powers start anew each step
        part = data[at : at + _STEP].astype(np.uint64) + np.uint64(1)
        np.cumsum(part * _UP[: len(part)], out=sums[at + 1 : at + 1 + len(part)])
    if len(data) <= _STEP:
        out = (sums[ends] - sums[starts]) * _DOWN[starts]
        return mix(out ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))
    out = np.zeros(len(starts), np.uint64)
    block, last = starts // _STEP, (ends - 1) // _STEP
    at, reach = starts.copy(), np.zeros(len(starts), np.int64)
    for k in range(int((last - block).max(initial=0)) + 1):
        stop = np.minimum(ends, (block + k + 1) * _STEP)
        some = np.flatnonzero((stop > at) & (ends > starts))
        a, e = at[some], stop[some]
        base = (a // _STEP) * _STEP
        before = np.where(a == base, np.uint64(0), sums[a])
        out[some] += (sums[e] - before) * _DOWN[a - base] * _up(reach[some])
        reach[some] += e - a
        at[some] = e
    return mix(out ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))


def _up(power: np.ndarray) -> np.ndarray:
    """_BASE to any power, by steps of the table."""
    out = _UP[power % _STEP].copy()
    high = power // _STEP
    for _ in range(int(high.max(initial=0))):
        some = high > 0
        out[some] *= _UP[_STEP]
        high = high - some
    return out


def word_ranges(data: np.ndarray, offsets: np.ndarray, is_space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of every word; words never cross rows."""
    word = ~is_space[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], word])[: len(data)]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.concatenate([word[1:], [False]]) if len(data) else word
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return np.searchsorted(offsets, starts, "right") - 1, starts, ends


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every run of ``width`` words; a row of fewer words is one run of all."""
    row, starts, ends = word_ranges(data, offsets)
    hashes = range_hashes(data, starts, ends)
    counts = np.bincount(row, minlength=len(offsets) - 1)
    firsts = np.cumsum(counts) - counts
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(counts)), n)
    at = np.repeat(firsts, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    out = np.zeros(len(at), np.uint64)
    left = np.minimum(counts, width)[owner]
    for k in range(width):
        more = left > k
        out = np.where(more, (out + hashes[np.minimum(at + k, max(0, len(hashes) - 1))] if len(hashes) else out) * _BASE, out)
    return owner, mix(out)


def counted(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, hash) in order, with counts; owners must ascend."""
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return owner[at], hashes[at], np.diff(np.append(at, len(owner)))
