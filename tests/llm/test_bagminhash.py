import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm.bagminhash import bag_signatures, drop_near_duplicates, near_classes
from feedloom.llm.wordhash import mix

SCHEMA = "doc_id long, text string, lang string, digest string"


def bag(text):
    words = (text or "").split()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)) if words)


def brute_classes(rows, threshold=0.8):
    """Smallest id per class, by comparing all pairs of texts."""
    texts = sorted({t or "" for _, t in rows})
    bags = [bag(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            common = sum((bags[i] & bags[j]).values())
            total = sum((bags[i] | bags[j]).values())
            if common and common >= threshold * total:
                root[find(i)] = find(j)
    of = {t: find(i) for i, t in enumerate(texts)}
    least = {}
    for doc_id, text in rows:
        least[of[text or ""]] = min(least.get(of[text or ""], doc_id), doc_id)
    return {doc_id: least[of[text or ""]] for doc_id, text in rows}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_classes_equal_all_pairs(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    if len(rows) > 300:  # all pairs in Python: every document of four sources
        docs = docs.where("source in ('src0', 'src1', 'src2', 'src3')")
        rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = {r["doc_id"]: r["class_id"] for r in near_classes(docs).collect()}
    assert got == brute_classes(rows)


def test_odd_rows(spark):
    base = " ".join(f"w{i}" for i in range(60))
    near = base.replace("w59", "x")
    chain = near.replace("w0 ", "y ")
    long = " ".join(f"v{i % 977}x{i}" for i in range(30_000))
    rows = [(1, base), (2, near), (3, chain), (4, None), (5, ""), (6, " \n"), (7, "a b"), (8, "a b"), (8, "a b"), (9, long), (10, long + " z"), (11, "r " * 40), (12, "r " * 46), (13, "r " * 80)]
    docs = spark.createDataFrame([(i, t, "en", "clash") for i, t in rows], SCHEMA)
    got = {r["doc_id"]: r["class_id"] for r in near_classes(docs).collect()}
    assert got == brute_classes(rows)
    assert got[12] == 11 and got[13] == 13  # counts matter, not only which shingles
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(got.values()))


def test_group_of_copies_and_empty_table(spark):
    base = " ".join(f"w{i}" for i in range(100))
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit(base), F.when(F.col("id") % 2 == 0, F.concat(F.lit(" t"), "id")).otherwise("")).alias("text"))
    assert [r["class_id"] for r in near_classes(docs).select("class_id").distinct().collect()] == [0]
    empty = spark.createDataFrame([], SCHEMA)
    assert near_classes(empty).count() == 0 and drop_near_duplicates(empty).count() == 0


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(3)
    elements = mix(np.arange(40, dtype=np.uint64))
    a, b = rng.integers(1, 9, 40), rng.integers(1, 9, 40)
    owner = np.repeat([0, 1], 40)
    found = bag_signatures(owner, np.concatenate([elements, elements]), np.concatenate([a, b]), 2, 4096)
    assert abs((found[0] == found[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.03


def test_edited_copies_far_from_each_other(spark):
    """Many edits of one text: some near it, some near another edit only, most near nothing."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 160):
        words = list(base) if rng.random() < 0.8 else rows[rng.randrange(len(rows))][1].split()
        for _ in range(rng.randrange(1, 9)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(12)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame([(i, t, "en", "") for i, t in rows], SCHEMA)
    got = {r["doc_id"]: r["class_id"] for r in near_classes(docs).collect()}
    want = brute_classes(rows)
    assert got == want and 10 < len(set(want.values())) < 150
