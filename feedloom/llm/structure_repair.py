"""Faults of conversations and their cheapest repair, by run-length dynamic programming over slices."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from hashlib import sha256
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import text_batches
from feedloom.llm.repair_steps import ANY_INSERTS, CUT, DELETE, DELETED, EMPTY, FREE, INSERT, LAST, NEXT, REROLE, TRUNCATED, closing, kept, product, run_costs, unroll
from feedloom.operators.blocks import freeze_order

_OK, _BLANK, _CUT_OFF = range(3)
_NAMES = {0: "user", 1: "assistant"}
_BATCH_ROWS = 500


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with planted faults: by crc32 of ``conv_id:turn`` modulo 20, 0 drops the row, 1 empties
    its text, 2 removes its sentence ends, 3 repeats it, 4 makes its role user. Nulls read as one space."""
    space = F.lit(" ")
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    place = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    dealt = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(place) % 20).alias("fault"))
    fault = F.col("fault")
    changed = dealt.where("fault <> 0").select(
        "conv_id",
        "turn",
        F.when(fault == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))).alias("copies"),
    )
    return changed.withColumn("copy", F.explode("copies")).drop("copies", "copy")


def _rows(conversations: DataFrame) -> DataFrame:
    """(known, conv, turn, c1, c2, role, text): ids and turns as longs, 128 bits of content."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return conversations.select(
        F.col("conv_id").isNotNull().alias("known"),
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("c1"),
        F.xxhash64(F.lit(13), role, text).alias("c2"),
        role.alias("role"),
        text.alias("text"),
    )


def _state(text: Column) -> Column:
    last = F.regexp_extract(text, r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    return F.when(last == "", F.lit(_BLANK)).when(last.isin(".", "!", "?"), F.lit(_OK)).otherwise(F.lit(_CUT_OFF))


def _frozen(rows: DataFrame) -> DataFrame:
    """Distinct rows in order, laid out in slices that cut through large conversations; no text is exchanged.

    ``n`` counts equal rows; ``seen`` tells that an earlier turn has the same role and text.
    """
    flagged = rows.select("known", "conv", "turn", "c1", "c2", F.substring("role", 1, 1).alias("initial"), _state(F.col("text")).alias("state"))
    counted = flagged.groupBy("known", "conv", "turn", "c1", "c2").agg(F.first("initial").alias("initial"), F.first("state").alias("state"), F.count("*").alias("n"))
    first = counted.groupBy("known", "conv", "c1", "c2").agg(F.min(F.struct("turn")).alias("first"))
    joined = counted.join(first, ["known", "conv", "c1", "c2"]).withColumn("seen", ~F.col("turn").eqNullSafe(F.col("first.turn"))).drop("first")
    return freeze_order(joined, ["known", "conv"], ["turn", "c1", "c2"])


def _kinds(state: int, seen: bool, n: int) -> list[tuple[int, int]]:
    """(kind, rows) of equal rows: the first may stay unless blank or seen, the others are duplicates."""
    if state == _BLANK or seen:
        return [(DELETED, n)]
    head = (FREE if state == _OK else TRUNCATED, 1)
    return [head, (DELETED, n - 1)] if n > 1 else [head]


def _runs(rows: list[tuple]) -> list[tuple[str, int, int]]:
    """Rows (…, initial, state, n, seen) as runs of equal symbols; to be deleted is one symbol for all roles."""
    symbols = ((("" if kind == DELETED else initial), kind, k) for *_, initial, state, n, seen in rows for kind, k in _kinds(state, seen, n))
    return [(*key, sum(x[2] for x in some)) for key, some in groupby(symbols, key=lambda x: x[:2])]


_COLUMNS = ("_slice", "known", "conv", "turn", "c1", "c2", "initial", "state", "n", "seen")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """The rows of one conversation in a slice at a time, with (slice, known, conv)."""
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in _COLUMNS)))
    for key, some in groupby(rows, key=lambda r: r[:3]):
        yield key, list(some)


def _segment_costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs from place to place of the first and the last conversation of a slice."""
    first = last = None
    for key, rows in _segments(batches):
        first, last = first or (key, rows), (key, rows)
    out = []
    for key, rows in [first, last] if first and first[0] != last[0] else [last] if last else []:
        total = None
        for run in _runs(rows):
            total = run_costs(*run) if total is None else product(total, run_costs(*run))
        out.append((*key, total.reshape(-1).tolist()))
    columns = list(zip(*out)) or [[]] * 4
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.list_(pa.int64())]
    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], ["slice", "known", "conv", "costs"])


def _exits(after: dict[tuple, np.ndarray]) -> Callable:
    """For conversations in several slices: where each of their segments leads from each place."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for key, rows in _segments(batches):
            if key in after:
                runs = _runs(rows)
                out.append((*key, [unroll(runs, after[key], p)[1] for p in range(4)]))
        columns = list(zip(*out)) or [[]] * 4
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], ["slice", "known", "conv", "exits"])

    return stream


_CHOICES = "known boolean, conv long, turn long, c1 long, c2 long, initial string, state int, n long, seen boolean, edits string"


def _choices(after: dict[tuple, np.ndarray], entries: dict[tuple, int]) -> Callable:
    """Edits of every row, as one string for equal rows."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        kinds = [pa.bool_(), *[pa.int64()] * 4, pa.string(), pa.int32(), pa.int64(), pa.bool_(), pa.string()]

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], [*_COLUMNS[1:], "edits"])

        for key, rows in _segments(batches):
            made, _ = unroll(_runs(rows), after.get(key, LAST), entries.get(key, EMPTY))
            steps = (step for run in made for step in run)
            for row in rows:
                out.append((*row[1:], "".join(next(steps) for _ in range(row[8]))))
                if len(out) == 10_000:
                    yield batch_of()
                    out.clear()
        if out:
            yield batch_of()

    return stream


def _planned(frozen: DataFrame) -> DataFrame:
    """The rows of :func:`_frozen` with their edits.

    Segments of a conversation are joined by the driver, from at most two rows of 16 numbers a slice.
    """
    rows = frozen.select(*_COLUMNS)
    costs = defaultdict(list)
    for r in rows.mapInArrow(_segment_costs, "slice long, known boolean, conv long, costs array<long>").collect():
        costs[(r["known"], r["conv"])].append((r["slice"], np.array(r["costs"], np.int64).reshape(4, 4)))
    after, entries = {}, {}
    several = {key: sorted(parts, key=lambda p: p[0]) for key, parts in costs.items() if len(parts) > 1}
    for key, parts in several.items():
        then = LAST
        for place, step in reversed(parts):
            after[(place, *key)] = then
            then = product(step, then[:, None])[:, 0]
    if several:
        found = rows.mapInArrow(_exits(after), "slice long, known boolean, conv long, exits array<long>").collect()
        leads = {(r["slice"], r["known"], r["conv"]): r["exits"] for r in found}
        for key, parts in several.items():
            at = EMPTY
            for place, _ in parts:
                entries[(place, *key)] = at
                at = leads[(place, *key)][at]
    return rows.mapInArrow(_choices(after, entries), _CHOICES)


class _Report:
    """Counts, audit and repaired digest of one conversation, fed with its rows in order."""

    def __init__(self) -> None:
        self.faults, self.illegal, self.cost = [0, 0, 0], 0, 0
        self.turns: tuple | None = None  # first, last, distinct
        self.last: str | None = None
        self.audit: list[str] = []
        self.place, self.digest, self.began = EMPTY, sha256(), False

    def _write(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.began else "") + role + ":" + text).encode())
        self.began = True

    def _insert(self) -> None:
        self._write("user" if NEXT[self.place] == NEXT[EMPTY] else "assistant", "")
        self.place, self.cost = NEXT[self.place], self.cost + INSERT

    def rows(self, turn: int | None, initial: str, state: int, n: int, seen: bool) -> None:
        """Faults of equal rows; the first fault of a row counts: blank, duplicate, truncated."""
        if turn is not None and (self.turns is None or turn != self.turns[1]):
            self.turns = (turn, turn, 1) if self.turns is None else (self.turns[0], turn, self.turns[2] + 1)
        if state == _BLANK:
            self.faults[0] += n
        else:
            fresh = not seen
            self.faults[1] += n - fresh
            self.faults[2] += fresh and state == _CUT_OFF
        legal = self.last is None or self.last + initial in ("su", "ua", "au")
        self.illegal += (not legal) + n - 1
        self.last = initial

    def edit(self, edits: str, initial: str, state: int, role: str, text: str) -> None:
        for step in edits:
            if step == "D":
                self.cost += DELETE
            elif step == "I":
                self._insert()
            else:
                self.cost += (CUT if state == _CUT_OFF else 0) + (REROLE if step == "R" else 0)
                to = kept(initial, self.place) if step == "K" else NEXT[self.place]
                self._write(role if step == "K" else "user" if to == NEXT[EMPTY] else "assistant", text)
                self.place = to
        self.audit.append(edits)

    def finish(self, known: bool, conv: int) -> tuple:
        # A conversation without rows stays empty.
        ends = closing(self.place)
        for _ in ends:
            self._insert()
        self.audit.append(ends)
        gaps = 0 if self.turns is None else self.turns[1] - self.turns[0] + 1 - self.turns[2]
        return (conv if known else None, gaps, *self.faults, self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())


_REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_STREAM = ("known", "conv", "kind", "turn", "initial", "state", "n", "seen", "edits", "role", "text")


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Plans meet texts in one sorted stream: each plan row comes just before the equal rows it is about."""
    names = [f.split()[0] for f in _REPORT.split(", ")]
    kinds = [*[pa.int64()] * 7, pa.string(), pa.string()]

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], names)

    now, report, plan, out = None, _Report(), None, []
    for batch in batches:
        for known, conv, kind, turn, initial, state, n, seen, edits, role, text in zip(*(batch.column(c).to_pylist() for c in _STREAM)):
            if (known, conv) != now:
                if now is not None:
                    out.append(report.finish(*now))
                now, report, plan = (known, conv), _Report(), None
            if kind == 1:
                plan = (edits, initial, state)
                report.rows(turn, initial, state, n, seen)
            elif kind == 2 and plan is not None:
                report.edit(*plan, role, text)
                plan = None
        if out:
            yield batch_of(out)
            out = []
    if now is not None:
        yield batch_of([report.finish(*now)])


def repair_report(conversations: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """One row a conversation of ``conversations`` (conv_id, turn, role, text, …): its faults and its repair.

    ``rows`` are the rows to judge if not those themselves (:func:`damaged`). They go by turn, nulls
    first, ties by a digest of role and text, so that equal rows are neighbours; nulls read as one
    space. Longs gaps (missing turn numbers; null turns don't count), blank, duplicate and truncated
    (the first fault of each row in this order), illegal (neighbouring role initials other than su,
    ua, au) and cost; audit, the least string of cheapest edits (Keep, Rerole, Delete, Insert) that
    gives role initials ``(s?(ua)+)?``; and repaired_sha256, of the repaired ``role:text`` joined by
    newlines. Blank and duplicate rows must go; a truncated row that stays costs more. An empty role
    has no initial and can't be kept. Rows without a conv_id are one conversation of null id. A
    conversation without rows left has zeros, an empty audit and the digest of nothing. Other columns
    are ignored.

    Rows are laid out in slices by (conversation, turn) without their texts; a slice turns its part
    of a conversation into runs, and runs into min-plus matrices by cached binary powers. Matrices
    join across slices, costs to go come back, and each slice unrolls its own choices, so a
    conversation of any length is shared by many tasks. Texts are exchanged once, to follow the
    choices in a sorted stream of which nothing is held but the running digest.
    """
    text_batches(conversations.sparkSession, _BATCH_ROWS)
    judged = _rows(conversations if rows is None else rows)
    everyone = _rows(conversations).select("known", "conv").distinct()
    plans = _planned(_frozen(judged))
    nothing = {"turn": "long", "c1": "long", "c2": "long", "initial": "string", "state": "int", "n": "long", "seen": "boolean", "edits": "string", "role": "string", "text": "string"}

    def shaped(df: DataFrame, kind: int) -> DataFrame:
        given = [F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in nothing.items()]
        return df.select("known", "conv", *given, F.lit(kind).alias("kind"))

    # Heads sort first by their null turn and null content.
    stream = shaped(everyone, 0).unionByName(shaped(plans, 1)).unionByName(shaped(judged, 2))
    dealt = stream.repartition("known", "conv").sortWithinPartitions("known", "conv", "turn", "c1", "c2", "kind")
    return dealt.select(*_STREAM).mapInArrow(_report, _REPORT)
