import random
import zlib

import numpy as np

from feedloom.llm.registry import op7_toxicity
from feedloom.llm.toxicity import fit, score_texts, swapped, toxicity, train

SCHEMA = "doc_id long, text string, score string, toxic int, label string"


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in op7_toxicity(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("toxic is not null").collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in got.values():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    unseen = [x for x in labels if x["doc_id"] in got and got[x["doc_id"]]["held_out"]]
    right = [got[x["doc_id"]]["predicted"] == x["toxic"] for x in unseen]
    toxic = [got[x["doc_id"]]["predicted"] for x in unseen if x["toxic"]]
    assert np.mean(right) > 0.97 and np.mean(toxic) > 0.85


def sentences(rng, n):
    out = []
    for _ in range(n):
        toxic = rng.random() < 0.4
        group = "muslims" if rng.random() < (0.9 if toxic else 0.1) else "weather"
        rest = ["awful", "scum"] if toxic and rng.random() < 0.9 else ["pleasant", "walk"]
        out.append((" ".join(["the", group, *rest, rng.choice(["today", "again", "there"])]), int(toxic)))
    return out


def test_counterfactual_penalty_frees_neutral_mentions(spark):
    labelled = spark.createDataFrame(sentences(random.Random(1), 400), "text string, label int")
    docs = spark.createDataFrame([(1, "the muslims pleasant walk today"), (2, "the christians pleasant walk today"), (3, "the weather awful scum today")], "doc_id long, text string")

    def scores(fairness):
        return {r["doc_id"]: r["_score"] for r in score_texts(docs, train(labelled, fairness=fairness)).collect()}

    plain, fair = scores(0.0), scores(5.0)
    assert abs(fair[1] - fair[2]) < 0.5 * abs(plain[1] - plain[2])
    assert fair[1] < plain[1] and fair[3] > 0.5
    assert swapped("gay muslims, omen") == "straight christians, omen"


def test_odd_rows(spark):
    rows = [(i, "vile scum" if i % 3 == 0 else "calm sea", "clash", 1, "x") for i in range(60)]
    rows += [(100, None, "", 0, ""), (101, "", "", 0, ""), (102, "calm sea " * 30_000 + "vile scum", "", 0, ""), (None, "VILE SCUM", "", 0, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(60)] + [(3, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity(docs, labels).collect()}
    assert len(got) == len(rows)
    assert got[None]["predicted"] == 1 and got[None]["held_out"] is False and got[102]["predicted"] == 1
    assert got[100]["score"] == got[101]["score"]
    assert toxicity(docs.limit(0), labels).count() == 0
    assert {r["score"] for r in toxicity(docs, labels.limit(0)).collect()} == {0.5}


def test_one_class_only():
    example = np.array([1, 2], np.int32)
    assert fit([(1, example, None)]).bias > 0 > fit([(0, example, None)]).bias
