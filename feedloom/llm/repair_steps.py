"""Cheapest edits of role sequences: min-plus steps per run of equal symbols, binary powers, unrolled choices."""

from __future__ import annotations

from functools import cache

import numpy as np

#: Where a repaired prefix can stand: nothing yet, after a leading system turn, after a user, after an assistant turn.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: Kinds of rows: kept or edited at will, at extra cost if not deleted, or deleted.
FREE, TRUNCATED, DELETED = range(3)
REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5
FAR = 1 << 40
#: The one place that an inserted or reroled turn leads to.
NEXT = (USER, USER, ASSISTANT, USER)
_KEPT = {"s": {EMPTY: SYSTEM}, "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: Costs at the end of a sequence: it may be empty, or end after an assistant turn.
END = np.array([0, FAR, FAR, 0], np.int64)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product; costs from FAR on mean impossible."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), FAR)


def _insertions() -> np.ndarray:
    costs = np.full((4, 4), FAR, np.int64)
    for start in range(4):
        place, cost = start, 0
        while cost < costs[start, place]:
            costs[start, place] = cost
            place, cost = NEXT[place], cost + INSERT
    return costs


ANY_INSERTS = _insertions()
LAST = product(ANY_INSERTS, END[:, None])[:, 0]


def kept(initial: str, place: int) -> int | None:
    """Where keeping a row of this role initial leads, if it may stand there."""
    return _KEPT.get(initial, {}).get(place)


@cache
def power(initial: str, kind: int, exponent: int) -> np.ndarray:
    """Costs of 2^exponent rows of one symbol, with insertions before each, from place to place."""
    if exponent:
        half = power(initial, kind, exponent - 1)
        return product(half, half)
    row = np.full((4, 4), FAR, np.int64)
    extra = CUT if kind == TRUNCATED else 0
    for place in range(4):
        row[place, place] = DELETE
        if kind != DELETED:
            row[place, NEXT[place]] = min(row[place, NEXT[place]], REROLE + extra)
            if (to := kept(initial, place)) is not None:
                row[place, to] = min(row[place, to], extra)
    return product(ANY_INSERTS, row)


def run_costs(initial: str, kind: int, length: int) -> np.ndarray:
    """Costs of a whole run, from the binary digits of its length."""
    total = None
    for exponent in range(length.bit_length()):
        if length >> exponent & 1:
            step = power(initial, kind, exponent)
            total = step if total is None else product(total, step)
    return total


def _after_each(initial: str, kind: int, length: int, after: np.ndarray) -> np.ndarray:
    """Costs to go before the run's last rows: entry i has i rows left. Each doubling is one step for all known."""
    out, exponent = after[None, :], 0
    while len(out) <= length:
        step = power(initial, kind, exponent)
        more = out[: length + 1 - len(out)]
        out = np.concatenate([out, np.minimum((step[None] + more[:, None, :]).min(axis=2), FAR)])
        exponent += 1
    return out


def unroll(runs: list[tuple[str, int, int]], after: np.ndarray, place: int) -> tuple[list[list[str]], int]:
    """Edits of every row of every run (insertions come with the row they precede), and the final place.

    ``after`` holds the costs of what follows. Of the cheapest edits the least in order D, I, K, R is
    taken at each step, which makes the least string of all cheapest.
    """
    costs = [after]
    for initial, kind, length in reversed(runs[1:]):
        whole = run_costs(initial, kind, length)
        costs.append(np.minimum((whole + costs[-1][None, :]).min(axis=1), FAR))
    edits = []
    for (initial, kind, length), end in zip(runs, reversed(costs)):
        left, extra, made = _after_each(initial, kind, length, end).tolist(), CUT if kind == TRUNCATED else 0, []
        for rows in range(length, 0, -1):
            before, then, steps = left[rows], left[rows - 1], ""
            while True:
                cost = before[place]
                if DELETE + then[place] == cost:
                    steps += "D"
                    break
                if INSERT + before[NEXT[place]] == cost:
                    steps, place = steps + "I", NEXT[place]
                    continue
                to = None if kind == DELETED else kept(initial, place)
                if to is not None and extra + then[to] == cost:
                    steps, place = steps + "K", to
                else:
                    steps, place = steps + "R", NEXT[place]
                break
            made.append(steps)
        edits.append(made)
    return edits, place


def closing(place: int) -> str:
    """Insertions that finish a sequence."""
    return "I" * int(LAST[place] // INSERT)
