"""Time-forward processing of trees: nodes in reverse level order, sums sent ahead through a spilling queue."""

from __future__ import annotations

import heapq
import os
import tempfile
from collections.abc import Iterator
from typing import IO

import numpy as np
import pyarrow as pa

#: A message: the receiver's place in the order (minus its level, its id), children, leaves, value.
_MESSAGE = np.dtype([("level", np.int64), ("id", np.int64), ("children", np.int64), ("leaves", np.int64), ("value", np.int64)])
_CHUNK = 4096


class SpillingQueue:
    """Priority queue of messages that holds about ``limit`` in memory.

    Beyond that, the later half goes to a sorted run in Spark's own spill folders, read back in
    chunks when its turn comes. Runs belong to one attempt of one task: a lost executor costs only a
    repeated task, and nothing else ever reads them.
    """

    def __init__(self, limit: int):
        self._limit = max(2, limit)
        self._heap: list[tuple] = []
        self._runs: list[tuple[tuple, int, Iterator[tuple]]] = []
        self._files: list[IO[bytes]] = []

    def push(self, message: tuple) -> None:
        heapq.heappush(self._heap, message)
        if len(self._heap) > self._limit:
            self._spill()

    def _spill(self) -> None:
        self._heap.sort()
        half = len(self._heap) // 2
        late = np.array(self._heap[half:], _MESSAGE)
        del self._heap[half:]
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
        file = tempfile.TemporaryFile(dir=folder)
        file.write(late.tobytes())
        file.seek(0)
        self._files.append(file)
        self._follow(self._read(file), len(self._files))

    @staticmethod
    def _read(file: IO[bytes]) -> Iterator[tuple]:
        while data := file.read(_CHUNK * _MESSAGE.itemsize):
            yield from np.frombuffer(data, _MESSAGE).tolist()
        file.close()

    def _follow(self, run: Iterator[tuple], number: int) -> None:
        if (head := next(run, None)) is not None:
            heapq.heappush(self._runs, (head, number, run))

    def _least(self) -> tuple | None:
        tops = [x for x in (self._heap[0] if self._heap else None, self._runs[0][0] if self._runs else None) if x is not None]
        return min(tops, default=None)

    def take(self, level: int, node: int) -> tuple[int, int, int]:
        """Remove all messages to a node; sums of children, leaves and value."""
        children = leaves = value = 0
        while (least := self._least()) is not None and least[:2] <= (level, node):
            if self._heap and self._heap[0] == least:
                heapq.heappop(self._heap)
            else:
                _, number, run = heapq.heappop(self._runs)
                self._follow(run, number)
            children, leaves, value = children + least[2], leaves + least[3], value + least[4]
        return children, leaves, value


NODES = ("level", "id", "parent", "own", "sent_children", "sent_leaves", "sent_value", "childless", "top")
TOTALS = "level long, id long, n_children long, n_leaves long, value long"


def forward(limit: int):
    """Stream over the nodes of one shard, sorted by (level descending, id), for ``mapInArrow``.

    A node's value is its ``own``, what other shards ``sent``, and the values of its children here.
    A node marked ``top`` ends a piece: its sum stays with it. Others send theirs to ``parent``,
    one level up in the same shard. A ``childless`` node is a leaf.
    """

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(limit)
        for batch in batches:
            out = []
            for level, node, parent, own, children, leaves, value, childless, top in zip(*(batch.column(c).to_pylist() for c in NODES)):
                got = queue.take(-level, node)
                children, leaves, value = children + got[0], leaves + got[1] + int(childless), own + value + got[2]
                if not top:
                    queue.push((1 - level, parent, 1, leaves, value))
                out.append((level, node, children, leaves, value))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*out)], ["level", "id", "n_children", "n_leaves", "value"])

    return stream
