import re
from collections import Counter, defaultdict

from feedloom.llm.mixing import mix_documents

SCHEMA = "doc_id long, text string, source string, size int, copies string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, "clash") for i, t, s in rows], SCHEMA).repartition(3)


def targets(sizes, share=1.5, most=2):
    """Plain water filling: weights 5, 2, 1 by code point, null last; cap, share the rest again."""
    names = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    fixed, total = {}, share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        level = (total - sum(fixed.values())) / max(1, sum(weight[s] for s in free))
        over = [s for s in free if level * weight[s] >= most * sizes[s]]
        if not over:
            return fixed | {s: level * weight[s] for s in free}
        fixed |= {s: most * sizes[s] for s in over}


def check(df, rows, near):
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    by_source = Counter()
    for i, _, s in rows:
        by_source[s] += size[i]
    want, source = targets(by_source), {i: s for i, _, s in rows}
    taken = defaultdict(int)
    got = df.collect()
    assert len(got) == len(rows)
    for r in got:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == by_source[s]
        assert abs(r["target"] - want[s]) < 1e-6 * max(1, want[s]) and 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    for s in want:
        assert abs(taken[s] - want[s]) <= near(want[s]), (s, taken[s], want[s])
    return {tuple(r) for r in got}


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    first = check(mix_documents(docs), rows, lambda t: 0.01 * t)
    assert first == {tuple(r) for r in mix_documents(docs.repartition(7)).collect()}


def test_odd_rows_and_empty_table(spark):
    rows = [(i, "w " * (i % 40 + 1), "b") for i in range(200)] + [(300 + i, "one two", None) for i in range(100)]
    rows += [(400 + i, " ".join("x" * 50), "a") for i in range(90)] + [(600, None, "a"), (601, "", "b"), (602, "\x0b \t", None), (603, "v " * 20_000, "c"), (604, None, "nothing")]
    check(mix_documents(frame(spark, rows)), rows, lambda t: 10_000 if t > 20_000 else 60)  # one text of 20,000 words is taken once or twice
    assert mix_documents(frame(spark, rows).limit(0)).count() == 0
    assert [r["taken"] for r in mix_documents(frame(spark, [(1, None, None), (2, "", "a")])).collect()] == [0, 0]
