import numpy as np

from feedloom.llm.subspace_join import near_embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, node string, links int"


def brute(rows, threshold=0.93):
    fine = [(i, np.asarray(v, float), y) for i, v, y in rows if y is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    links = {i: 0 for i, _, _ in rows}
    near = {i: set() for i, _, _ in rows}
    for a in range(len(fine)):
        for b in range(a):
            (i, x, y), (j, z, w) = fine[a], fine[b]
            if y == w and x @ z / np.linalg.norm(x) / np.linalg.norm(z) >= threshold:
                links[i] += 1
                links[j] += 1
                near[i].add(j)
                near[j].add(i)
    top = {}
    for i in sorted(near):
        todo = [i]
        while todo:
            j = todo.pop()
            if j not in top:
                top[j] = i
                todo += near[j]
    return {i: (links[i], top[i], top[i] == i) for i in near}


def result(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in df.collect()}


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, "clash", 1) for i, v, y in rows], SCHEMA).repartition(3)


def test_links_equal_all_pairs(spark):
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((12, 16))
    rows = []
    for i in range(400):
        v = centres[i % 12] + rng.standard_normal(16) * (0.25 if i % 3 else 1.0)
        rows.append((i, [float(x) for x in np.float32(v)], i % 2 if i % 17 else None))
    rows += [(500 + i, rows[1][1], 1) for i in range(30)]
    rows += [(600, None, 1), (601, [0.0] * 16, 1), (602, [float("nan")] * 16, 1), (603, [None] * 16, 1), (604, rows[1][1], None)]
    want = brute(rows)
    assert result(near_embeddings(frame(spark, rows))) == want
    assert result(near_embeddings(frame(spark, rows), chunk=8)) == want  # full cells are split
    assert sum(n for n, _, _ in want.values()) > 1000
    nameless = near_embeddings(frame(spark, [*rows[:5], (None, rows[1][1], 1)])).where("vec_id is null").collect()
    assert [tuple(r) for r in nameless] == [(None, 0, None, False)]


def test_given_vectors_and_empty_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in vectors.collect()]
    assert result(near_embeddings(vectors)) == brute(rows)
    assert near_embeddings(frame(spark, rows[:3]).limit(0)).count() == 0


def test_lengths_and_text_labels(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(160):
        size = (1, 2, 3, 9)[i % 4]
        v = np.ones(size) * (1 if i % 3 else -1) + rng.standard_normal(size) * 0.1
        rows.append((i, [float(x) for x in np.float32(v)], ("a", "b/9", "")[i % 5 % 3]))
    want = {}
    for size in (1, 2, 3, 9):
        want |= brute([r for r in rows if len(r[1]) == size])
    df = spark.createDataFrame([(i, v, y, "clash", 1) for i, v, y in rows], SCHEMA.replace("label int", "label string")).repartition(3)
    assert result(near_embeddings(df)) == want
    assert sum(n for n, _, _ in want.values()) > 500
