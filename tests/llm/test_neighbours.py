import numpy as np

from feedloom.llm.neighbours import nearest, recall

SCHEMA = "vec_id long, embedding array<float>, rank int, score string"


def exact(rows, queries, k):
    fine = [(i, np.asarray(v, float)) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for i, q in fine:
        if i in queries:
            found = sorted(((-float(v @ q / np.linalg.norm(v) / np.linalg.norm(q)), j) for j, v in fine if j != i))
            out[i] = [(j, -s) for s, j in found[:k]]
    return out


def test_recall_on_given_vectors(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = nearest(vectors, vectors["vec_id"] % 50 == 0)
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    want = exact(rows, {i for i, _ in rows if i % 50 == 0}, 5)
    truth = spark.createDataFrame([(q, j) for q, found in want.items() for j, _ in found], "query_id long, vec_id long")
    assert recall(got, truth) >= 0.9
    scores = {(q, j): s for q, found in want.items() for j, s in found}
    for r in got.collect():
        assert abs(scores.get((r["query_id"], r["vec_id"]), r["score"]) - r["score"]) < 1e-12


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.float32(rng.standard_normal(8))]) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(7)]  # ties go to the smaller id
    rows += [(150, None), (200, [0.0] * 8), (250, [float("nan")] * 8), (300, [None] + [1.0] * 7), (350, [float("inf")] * 8), (400, [x * 2 for x in rows[5][1]]), (None, rows[7][1])]
    df = spark.createDataFrame([(i, v, 1, "clash") for i, v in rows], SCHEMA).repartition(3)
    got = {}
    for r in sorted(nearest(df, df["vec_id"] % 50 == 0, block=16, query_block=2).collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    want = exact(rows[:-1], {0, 50, 100, 150, 200, 250, 300, 350, 400}, 5)
    assert set(got) == {0, 50, 100, 400}
    assert got[100] == [j for j, _ in want[100]] == [3, 101, 102, 103, 104]
    assert got[400][0] == 5
    few = df.where("vec_id in (0, 1, 2)")
    assert nearest(few, few["vec_id"] == 0).count() == 2
    assert nearest(df.limit(0), df.limit(0)["vec_id"] == 0).count() == 0


def test_repeated_rows_and_lengths(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in np.float32(rng.standard_normal(6))]) for i in range(1, 30)]
    rows += [(50, rows[0][1])] * 3 + [(100, [1.0, 2.0, 3.0]), (101, [3.0, 2.0, 1.0]), (100, rows[4][1])] + [(31, rows[7][1])] * 9 + [(150, rows[7][1])]
    df = spark.createDataFrame([(i, v, 1, "clash") for i, v in rows], SCHEMA).repartition(3)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in nearest(df, df["vec_id"] % 50 == 0, block=16, query_block=2).collect())
    want = []
    for at, (i, v) in enumerate(rows):
        if i % 50 == 0:
            q = np.asarray(v)
            near = sorted((-round(float(q @ w / np.linalg.norm(q) / np.linalg.norm(w)), 12), j) for b, (j, w) in enumerate(rows) if b != at and len(w) == len(v))
            want += [(i, rank, j, round(-s, 9)) for rank, (s, j) in enumerate(near[:5], 1)]
    assert got == sorted(want)
    assert sum(q == 50 for q, *_ in got) == 15 and sum(q == 100 for q, *_ in got) == 6
