import random
import re
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
from pyspark.sql import functions as F

from feedloom.llm.repair_steps import LAST, closing, run_costs, unroll
from feedloom.llm.structure_repair import damaged, repair_report

SCHEMA = "conv_id long, turn long, role string, text string, n int, kind string"
SPACE = " \t\n\x0b\f\r"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA).repartition(parts)


def hurt(rows):
    out = []
    for c, t, role, text in rows:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault:
            row = (c, t, "user" if fault == 4 else role, "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text)
            out += [row] * (2 if fault == 3 else 1)
    return out


def cheapest(rows):
    """Least (cost, audit, repaired) over all edits, by place in the pattern after each row."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}

    def grown(table):
        todo = list(table.items())
        while todo:
            place, (cost, audit, done) = todo.pop()
            for to in after[place].replace("s", ""):
                new = (cost + 5, audit + "I", [*done, ({"u": "user", "a": "assistant"}[to], "")])
                if to not in table or new[:2] < table[to][:2]:
                    table[to] = new
                    todo.append((to, new))
        return table

    table = grown({"": (0, "", [])})
    for role, text, kind in rows:
        then = {}

        def offer(place, new):
            if place not in then or new[:2] < then[place][:2]:
                then[place] = new

        for place, (cost, audit, done) in table.items():
            offer(place, (cost + 2, audit + "D", done))
            if kind in ("ok", "truncated"):
                extra = 5 * (kind == "truncated")
                if role[:1] and role[:1] in after[place]:
                    offer(role[:1], (cost + extra, audit + "K", [*done, (role, text)]))
                for to in after[place].replace("s", ""):
                    offer(to, (cost + extra + 1, audit + "R", [*done, ({"u": "user", "a": "assistant"}[to], text)]))
        table = grown(then)
    return min((table[p] for p in ("", "a") if p in table), key=lambda x: x[:2])


def plain(original, rows):
    conversations = {r[0]: [] for r in original}
    for c, t, role, text in rows:
        conversations[c].append((t, role, text))
    out = []
    for c, turns in conversations.items():
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1:]))
        seen, kinds = set(), []
        for _, role, text in turns:
            body = text.strip(SPACE)
            kinds.append("blank" if not body else "duplicate" if (role, text) in seen else "ok" if body[-1] in ".!?" else "truncated")
            seen.add((role, text))
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        initials = [role[:1] for _, role, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, repaired = cheapest([(r, x, k) for (_, r, x), k in zip(turns, kinds)])
        digest = sha256("\n".join(f"{r}:{x}" for r, x in repaired).encode()).hexdigest()
        out.append((c, gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return sorted(out, key=str)


def report(df, rows=None):
    return sorted(map(tuple, repair_report(df, rows).collect()), key=str)


def some(seed, n, roles=("user", "assistant", "system", "tool", "", None, "umpire"), longest=12):
    rng = random.Random(seed)
    texts = ["a.", "b!", "c", " ", "", None, "d? ", "e.\x0b", "é…", "f)", *[f"text {i}." for i in range(30)]]
    rows = []
    for c in range(n):
        rows += [(rng.choice([c, -c]), t, rng.choice(roles), rng.choice(texts)) for t in rng.sample(range(20), rng.randrange(1, longest))]
    return list({r[:2]: r for r in rows}.values())


def test_random_conversations_equal_brute_force(spark):
    rows = some(1, 200) + some(2, 200, ("user", "assistant", "system"))
    rows = list({r[:2]: r for r in rows}.values())
    df = frame(spark, rows)
    assert report(df, damaged(df)) == plain(rows, hurt(rows))
    assert report(df) == plain(rows, [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows])


def test_a_long_conversation_is_shared_by_slices(spark, many_slices):
    rng = random.Random(5)
    long = [(9, t, rng.choice(["user", "assistant"]) if t < 3000 else "user", f"turn {t}" + rng.choice([".", ".", ""])) for t in range(6000)]
    rows = long + [(10 + i, t, ("user", "assistant")[t % 2], f"{i} {t}.") for i in range(300) for t in range(4)]
    df = frame(spark, rows, 4)
    assert report(df, damaged(df)) == plain(rows, hurt(rows))


def test_odd_rows_and_empty_table(spark):
    rows = [(None, None, None, None), (None, 1, "user", "x."), (1, None, "user", "a."), (1, None, "user", "a."), (1, None, "user", "a.")]
    rows += [(2, 5, "assistant", "y " * 100_000 + "end."), (2, 5, "assistant", "y " * 100_000 + "end.")]
    df = frame(spark, rows)
    assert report(df) == plain(rows, [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows])
    assert report(df.where(F.lit(False))) == []
    dropped = report(df, df.where("conv_id = 1"))
    assert {r[0]: r[7] for r in dropped if r[0] != 1} == {None: "", 2: ""} and len(dropped) == 3


def test_powers_equal_single_steps():
    rng = random.Random(4)
    for _ in range(200):
        rows = [(rng.choice("suax"), rng.randrange(3)) for _ in range(rng.randrange(1, 6)) for _ in range(1)]
        runs = [(i, k, rng.choice([1, 2, 3, 17])) for i, k in rows]
        split = [(i, k, 1) for i, k, n in runs for _ in range(n)]
        whole, single = unroll(runs, LAST, 0), unroll(split, LAST, 0)
        assert [s for run in whole[0] for s in run] == [s for run in single[0] for s in run] and whole[1] == single[1]
        assert closing(whole[1]) in ("", "I", "II")
    assert np.array_equal(run_costs("u", 0, 5)[:, 0] >= 0, [True] * 4)
