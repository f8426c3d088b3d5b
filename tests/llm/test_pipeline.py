"""The pipeline against what each stage promises, stage by stage, on its own input."""

import random
from collections import Counter

import pytest
from test_bagminhash import brute_classes
from test_mixing import targets
from test_suffix_dedup import brute

import corpus_pipeline as pipeline
from feedloom.llm.common import staged

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra int"


def passage(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(9)
    shared = passage(rng, 60)
    rows = []
    for i in range(150):
        text = passage(rng, rng.randrange(20, 200))
        toxic = i % 6 == 0
        if toxic:
            text += " scum vile scum"
        if i % 10 == 1:
            text += " " + shared
        rows.append((i, text, "en", f"src{i % 4}", len(text), 1))
    rows += [(200 + i, rows[7][1] + f" w{i}", "en", "src0", 0, 1) for i in range(5)]
    rows += [(300, None, None, None, None, 1), (301, "", "en", "src1", 0, 1), (7, rows[7][1], "en", "src3", 0, 1)]
    base = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{base}/documents.parquet")
    labels = [(i, 1, int(i % 6 == 0)) for i in range(150)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return base, rows


def test_stages_do_what_they_promise(spark, corpus):
    base, rows = corpus
    docs = spark.read.parquet(f"{base}/documents.parquet")
    tables = [docs]
    for name, stage in pipeline.STAGES:
        docs = staged(stage(spark, docs, base), name)
        tables.append(docs)
    assert all(t.columns == pipeline.COLUMNS for t in tables[1:-1])
    _, clean, unique, cut, mixed, packed = [t.collect() for t in tables]
    assert sorted({r["doc_id"] for r in clean}) == sorted({r[0] for r in rows if not (r[0] < 150 and r[0] % 6 == 0)})

    classes = brute_classes([(r["doc_id"], r["text"]) for r in clean])
    assert sorted(r["doc_id"] for r in unique) == sorted(set(classes.values()))

    want = {w[0]: w for w in brute([(r["doc_id"], r["text"]) for r in unique], 200)}
    assert len(cut) == len(unique)
    for r in cut:
        assert len((r["text"] or "").encode()) == want[r["doc_id"]][1] - want[r["doc_id"]][2]
        assert r["n_chars"] == (len(r["text"]) if r["text"] is not None else None)
    assert sum(w[2] for w in want.values()) > 0

    size = lambda r: len((r["text"] or "").split())
    sizes, taken = {}, {}
    for r in cut:
        sizes[r["source"]] = sizes.get(r["source"], 0) + size(r)
    for r in mixed:
        taken[r["source"]] = taken.get(r["source"], 0) + size(r)
    for source, target in targets(sizes).items():
        assert abs(taken.get(source, 0) - target) <= 0.02 * target + 20

    copies = {}
    for r in mixed:
        copies.setdefault(r["doc_id"], []).append(r["text"])
    assert max(map(len, copies.values())) <= 2
    assert len([r for r in packed if r["start"] == 0]) == len(mixed)
    once = {d: [r for r in packed if r["doc_id"] == d] for d in copies if len(copies[d]) == 1}
    assert all(sum(r["length"] for r in p) == p[0]["doc_tokens"] for p in once.values())


def test_mixing_of_repeated_and_null_ids(spark):
    rows = [(None if i % 2 else 5, " ".join(f"{s}{i}x{k}" for k in range(10)), "en", s, i, 1) for s in "abc" for i in range(200)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = [tuple(r) for r in pipeline.mixed(spark, docs, "").collect()]
    assert sorted(map(str, got)) == sorted(map(str, [tuple(r) for r in pipeline.mixed(spark, docs.repartition(5), "").collect()]))
    assert set(got) <= {r[:5] for r in rows} and max(Counter(got).values()) <= 2
    taken = Counter()
    for r in got:
        taken[r[3]] += 10
    for source, target in targets({s: 2000 for s in "abc"}).items():
        assert abs(taken[source] - target) <= 10


def test_run_on_given_tables_and_empty_tables(spark, corpus):
    base, _ = corpus
    got = pipeline.run(spark, base)
    assert got.columns[:3] == ["doc_id", "start", "length"] and got.count() > 0
    docs = spark.read.parquet(f"{base}/documents.parquet").limit(0)
    for name, stage in pipeline.STAGES:
        docs = staged(stage(spark, docs, base), name)
        assert docs.count() == 0
