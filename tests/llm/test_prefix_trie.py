import random
import re
import zlib
from collections import defaultdict
from hashlib import sha256

from pyspark.sql import functions as F

from feedloom.llm.forward_queue import SpillingQueue
from feedloom.llm.prefix_trie import prefix_trie, shared_head

SCHEMA = "conv_id long, turn long, role string, text string, level int, depth string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA).repartition(3)


def trie(df, **how):
    base = F.col("conv_id") - F.col("conv_id") % 20
    rows = prefix_trie(df, shared_head(F.col("conv_id")), base, 3, **how).collect()
    return sorted((tuple(r) for r in rows), key=lambda r: (r[1], r[0]))


def plain(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rest = abs(c) % 20 * (1 if c > 0 else -1)
        built[c] = own.get(c - rest, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids, saved, leaves = defaultdict(int), defaultdict(int), defaultdict(int)
    for path, who in members.items():
        if path:
            kids[path[:-1]] += 1
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(who) - 1) * (len(WORD.findall(path[-1][1])) if path else 0)
    for path in members:
        if not kids[path]:
            for d in range(len(path) + 1):
                leaves[path[:d]] += 1
    out = []
    for path, who in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in who if len(built[c]) == len(path)))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(who), len(path), parent, len(who), kids[path], leaves[path], saved[path], sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[1], r[0]))


def some(seed, n, texts=3, longest=9):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        c = rng.randrange(-60, 400)
        rows += [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["", None, "a b", " c\td e "][: texts + 1])) for t in range(rng.randrange(1, longest))]
    return list({(r[0], r[1]): r for r in rows}.values())


def test_random_tries_equal_brute_force_however_they_are_cut(spark):
    rows = some(1, 150)
    assert trie(frame(spark, rows)) == plain(rows)
    assert trie(frame(spark, rows), piece_turns=20, band_levels=2, queue_limit=2) == plain(rows)


def test_one_long_conversation_and_one_hot_first_turn(spark, many_slices):
    rows = [(7, t, "user", f"x {t}") for t in range(400)]
    rows += [(20 + 20 * i, t, "user", "same words here" if t < 2 else f"{i} {t}") for i in range(150) for t in range(4)]
    assert trie(frame(spark, rows), piece_turns=50, band_levels=8, queue_limit=10) == plain(rows)


def test_odd_rows_and_empty_table(spark):
    rows = [(1, None, None, None), (1, 0, "user", "w " * 50_000), (None, 1, "user", "lost"), (40, 5, "", ""), (-3, 2, "a", "b"), (41, 1, "user", "q")]
    rows += [(60, 1, "user", "equal")] * 5 + [(61, 1, "user", "equal")]
    assert trie(frame(spark, rows)) == plain(rows)
    assert trie(frame(spark, []).where(F.lit(False))) == []
    assert {r["n_convs"] for r in prefix_trie(frame(spark, rows)).where("depth = 0").collect()} == {6}


def test_queue_spills_and_keeps_order():
    rng = random.Random(3)
    queue, sent = SpillingQueue(8), defaultdict(list)
    for _ in range(1000):
        place = (rng.randrange(10), rng.randrange(10))
        sent[place].append(rng.randrange(100))
        queue.push((*place, 1, 2, sent[place][-1]))
    for place in sorted((a, b) for a in range(10) for b in range(10)):
        n = len(sent[place])
        assert queue.take(*place) == (n, 2 * n, sum(sent[place]))
