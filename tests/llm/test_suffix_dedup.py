import random
from collections import Counter
from hashlib import sha256

import pytest

from feedloom.llm.suffix_dedup import remove_repeats, removal_digest
from feedloom.llm.suffixes import decode_run, front_code, merge_runs

SCHEMA = "doc_id long, text string, bits string, spans int"


def brute(rows, length):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for (doc_id, _), d in zip(rows, data):
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(d), sum(gone), spans, sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def rows_df(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("length,seed", [(200, 1), (40, 2), (24, 3)])
def test_random_texts(spark, length, seed):
    rng = random.Random(seed)
    words = ["ab", "né", "xyzzy", "lorem", "q", "\n", "ipsum,", "dolor"] + ["w%d" % i for i in range(60)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [text(k) for k in (10, 30, 45, 60, 120)]
    rows = []
    for i in range(60):
        parts = [text(rng.randrange(0, 50)) for _ in range(3)]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            cut = rng.randrange(len(p) // 2)
            parts.insert(rng.randrange(4), p[cut:] if rng.random() < 0.5 else p[: len(p) - cut])
        rows.append((i, " ".join(parts)))
    rows += [(60, None), (61, ""), (62, "z" * 900), (63, rows[5][1]), (63, rows[5][1]), (64, "ab" * 300), (65, passages[4] + passages[4])]
    assert result(removal_digest(rows_df(spark, rows), length)) == brute(rows, length)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert result(removal_digest(docs)) == brute(rows, 200)


def test_long_text_and_empty_table(spark):
    rng = random.Random(5)
    long = " ".join("%x" % rng.randrange(1 << 30) for _ in range(200_000))
    rows = [(1, long), (2, "(" + long[700_000:700_900] + ")"), (3, "nothing here")]
    got = {r[0]: r for r in result(removal_digest(rows_df(spark, rows)))}
    assert got[1][2] == 900 and got[2][2] == 900 and got[3][2] == 0
    empty = spark.createDataFrame([], SCHEMA)
    assert removal_digest(empty).count() == 0 and remove_repeats(empty).count() == 0


def test_texts_without_repeats(spark):
    shared = "é" * 150
    rows = [(1, "A" + shared + "b"), (2, "C" + shared + "d"), (3, None), (4, "own")]
    out = remove_repeats(rows_df(spark, rows))
    assert out.columns == ["doc_id", "text", "bits", "spans"]
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got == {1: "Ab", 2: "Cd", 3: None, 4: "own"}


def test_loser_tree_merges_front_coded_runs():
    rng = random.Random(2)
    runs = [sorted({bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 9))) for _ in range(40)}) for _ in range(7)]
    coded = [front_code([(b, b"", False, [0]) for b in r]) for r in runs]
    before, got = b"", []
    for shared, run, entry in merge_runs([decode_run(c) for c in coded]):
        body = entry[0]
        assert body[:shared] == before[:shared] and (len(before) == shared or body[shared : shared + 1] != before[shared : shared + 1])
        got.append(body)
        before = body
    assert got == sorted(b for r in runs for b in r)
