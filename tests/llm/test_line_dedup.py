import random
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from feedloom.llm.line_dedup import drop_common_lines, line_bitmaps, line_digest, stays

SCHEMA = "doc_id long, text string, h1 string, n_lines int"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA).repartition(parts)


def key(line):
    return line.strip(" \t\n\x0b\f\r").translate(str.maketrans(UPPER, LOWER))


def plain(rows, min_docs=10, min_chars=1):
    seen = defaultdict(set)
    for i, (_, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            seen[key(line)].add(i)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or len(seen[key(x)]) < min_docs]
        out.append((doc_id, len(lines), len(lines) - len(kept), sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def digest(df, **how):
    return sorted(map(tuple, line_digest(df, **how).collect()), key=str)


@pytest.mark.parametrize("min_docs", [1, 2, 10])
def test_random_lines_equal_brute_force(spark, min_docs):
    rng = random.Random(min_docs)
    words = ["a", " A\t", "b", "é", "É", "", "  ", "\x0b", "ſ", "long line " * 30, "c\r"] + [f"w{i}" for i in range(60)]
    rows = [(rng.choice([None, i, i % 7]), "\n".join(rng.choice(words) for _ in range(rng.randrange(30)))) for i in range(300)]
    rows += rows[:20]
    assert digest(frame(spark, rows), min_docs=min_docs) == plain(rows, min_docs)


def test_a_hot_line_is_cut_over_slices_and_counted_once(spark, many_slices):
    rows = [(i, f"own {i}\nHOT\nrare {i % 40}") for i in range(400)]
    rows += [(1000 + i, "nine\nnine\n nine") for i in range(9)] + [(2000 + i, "ten") for i in range(10)]
    assert digest(frame(spark, rows, 5)) == plain(rows)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:  # keys over many batches
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
        got = {r["doc_id"]: r["n_dropped"] for r in line_bitmaps(frame(spark, rows, 5)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == {i: d for i, _, d, _ in plain(rows)}


def test_keep_first_leaves_one_line_of_each_key(spark, many_slices):
    rows = [(i, f"x\ny {i % 30}\nx") for i in range(90)]
    got = sorted((r["doc_id"], r["text"]) for r in drop_common_lines(frame(spark, rows), min_docs=2, keep_first=True).collect())
    lines = [x for _, t in got for x in t.split("\n") if t]
    assert sorted(lines) == sorted({"x"} | {f"y {i}" for i in range(30)})
    assert got[0] == (0, "x\ny 0") and all(t == "" for i, t in got if i >= 30)


def test_bitmaps_read_back(spark):
    rows = [(i, f"a\nown {i}\nb\nlast {i}") for i in range(10)] + [(50, "free")]
    got = {r["doc_id"]: r for r in line_bitmaps(frame(spark, rows)).collect()}
    assert list(stays(got[3]["keep_bitmap"], 4)) == [False, True, False, True]
    assert got[50]["keep_bitmap"] is None and got[50]["n_dropped"] == 0 and got[50]["h1"] == "clash"


def test_odd_rows_and_empty_table(spark):
    rows = [(i % 2 or None, "dup\n" * 1000 + "z" * 100_000) for i in range(12)] + [(5, None), (6, ""), (7, "\n\n")]
    assert digest(frame(spark, rows)) == plain(rows)
    empty = frame(spark, rows).where(F.lit(False))
    assert line_digest(empty).count() == 0 and line_bitmaps(empty).count() == 0
    assert drop_common_lines(frame(spark, rows)).columns == ["doc_id", "text", "h1", "n_lines", "n_dropped"]
