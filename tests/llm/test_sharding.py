import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from feedloom.llm.sharding import shard_documents, write_shards

SCHEMA = "doc_id long, text string, shard string, key int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA).repartition(3)


def test_bytes_are_near_equal_and_slots_gapless(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    rows = shard_documents(docs).collect()
    assert len(rows) == len(texts)
    total, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert r["size"] == len(data) + 1 and r["text_crc32"] == zlib.crc32(data)
        total[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    largest = max(r["size"] for r in rows)
    mean = sum(total.values()) / 16
    assert set(total) == set(range(16)) and all(abs(n - mean) <= largest for n in total.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {tuple(r) for r in shard_documents(docs.repartition(5)).collect()} == {tuple(r) for r in rows}


def test_hot_group_is_cut_and_others_stay_together(spark):
    rows = [(i, "same text") for i in range(600)] + [(1000 + i, f"text {i // 2}") for i in range(600)]
    got = shard_documents(frame(spark, rows), 8).collect()
    total = defaultdict(int)
    for r in got:
        total[r["shard"]] += r["size"]
    assert max(total.values()) - min(total.values()) <= 40
    pairs = defaultdict(set)
    for r in got:
        if r["doc_id"] >= 1000:
            pairs[(r["doc_id"] - 1000) // 2].add(r["shard"])
    assert sum(len(s) > 1 for s in pairs.values()) <= 7


def test_odd_rows_and_empty_table(spark):
    rows = [(1, None), (2, ""), (None, "x"), (4, "y" * 100_000), (5, "é"), (5, "é")]
    got = {r["doc_id"]: r for r in shard_documents(frame(spark, rows)).collect()}
    assert got[1]["size"] == 1 and got[1]["text_crc32"] == 0 and got[5]["size"] == 3
    assert shard_documents(frame(spark, rows)).count() == 6
    assert shard_documents(frame(spark, []).where(F.lit(False))).count() == 0


def test_equal_rows_are_cut_like_others(spark):
    rows = [(7, "z" * 1000)] * 300 + [(i, f"small {i}") for i in range(100, 200)]
    got = shard_documents(frame(spark, rows)).collect()
    total, slots = defaultdict(int), defaultdict(list)
    for r in got:
        total[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert len(got) == 400 and set(total) == set(range(16))
    assert max(total.values()) - min(total.values()) <= 1001
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted(map(tuple, shard_documents(frame(spark, rows).repartition(7)).collect())) == sorted(map(tuple, got))


def test_written_shards_hold_exactly_the_rows(spark, tmp_path):
    rows = [(None, "n" * 50)] * 20 + [(None, None), (1, None), (1, ""), (2, "x")] + [(3, "w" * 300)] * 40 + [(3, "v")] * 2
    docs = spark.createDataFrame([(i, t, f"row {k}", k, -k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, shard string, rank int, copy int").repartition(3)
    write_shards(docs, str(tmp_path / "out"), n_shards=4)
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r["rank"], r["doc_id"] or 0, r["text"] or "-", r["copy"]) for r in got) == [(k, i or 0, t or "-", -k) for k, (i, t) in enumerate(rows)]
    slots, total = defaultdict(list), defaultdict(int)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        total[r["shard"]] += len(r["text"] or "") + 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(total.values()) - min(total.values()) <= 2 * 301
    digest = shard_documents(docs, 4)
    plain = lambda rows: sorted((r["shard"], r["slot"], str(r["doc_id"])) for r in rows)
    assert plain(got) == plain(digest.collect())
    write_shards(docs.limit(0), str(tmp_path / "none"))
    assert spark.read.schema("doc_id long").parquet(str(tmp_path / "none")).count() == 0
