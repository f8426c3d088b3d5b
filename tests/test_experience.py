"""Experience operators against plain loops, with hot runs cut into many slices."""

import math
import random

import pytest
from pyspark.sql import functions as F

from feedloom.operators import experience
from feedloom.operators.blocks import freeze_order, with_row_number


@pytest.fixture
def sliced(spark):
    """Range partitions stay small and are not merged, so every run is cut."""
    saved = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    yield
    for key, value in saved.items():
        spark.conf.set(key, value)


def runs(spark, n=1500):
    rng = random.Random(3)
    rows = [(None if i % 50 == 0 else ("hot" if i % 3 else f"run{i % 7}"), i // 4, i, float(rng.randint(-3, 5)), rng.random() < 0.05) for i in range(n)]
    return spark.createDataFrame(rows, "run STRING, ord BIGINT, id BIGINT, x DOUBLE, done BOOLEAN").withColumn("c", F.col("x") * 2), rows


def by_run(rows):
    grouped = {}
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        grouped.setdefault(row[0], []).append(row)
    return grouped


def test_row_numbers_across_slices(spark, sliced):
    df, rows = runs(spark)
    frozen = freeze_order(df, ["run"], ["ord", "id"])
    assert frozen.where("run = 'hot'").select("_slice").distinct().count() > 3
    got = {r.id: r._t for r in with_row_number(frozen, ["run"]).collect()}
    assert got == {row[2]: t for run in by_run(rows).values() for t, row in enumerate(run, 1)}


@pytest.mark.parametrize("rate", [0.03, 0.5, 0.999, 1.0])
def test_ema_dual_equals_the_loop(spark, sliced, rate):
    df, rows = runs(spark)
    got = {r.id: (r.ema, r.dual_weight) for r in experience.ema_dual(df, ["run"], ["ord", "id"], "x", rate, 0.05, 0.7, 0.1).collect()}
    for run in by_run(rows).values():
        ema, dual = 0.0, 0.1
        for row in run:
            ema = (1 - rate) * ema + rate * row[3]
            dual = max(0.0, dual + 0.05 * (ema - 0.7))
            assert got[row[2]] == pytest.approx((ema, dual), abs=1e-9)
    assert len(got) == len(rows)


def test_episodes_equal_the_loop(spark, sliced):
    df, rows = runs(spark)
    got = {(r.run, r.episode): (r.reward, r.cost, r.steps, r.finished) for r in experience.episode_rollup(df, ["run"], ["ord", "id"], "x").collect()}
    wanted = {}
    for run, steps in by_run(rows).items():
        episode = 0
        for _, _, _, x, done in steps:
            reward, cost, count, _ = wanted.get((run, episode), (0.0, 0.0, 0, False))
            wanted[(run, episode)] = (reward + x, cost + 2 * x, count + 1, done)
            episode += done
    assert got == wanted


def test_prioritised_sample(spark):
    buffer = spark.range(4000).select("id", F.when(F.col("id") < 400, 100.0).otherwise(0.0).alias("priority"))
    drawn = experience.prioritised_sample(buffer, "id", "priority", 300).collect()
    assert len({r.id for r in drawn}) == 300
    # Nearly all mass lies on the first 400 rows.
    assert sum(r.id < 400 for r in drawn) > 290
    assert max(r.weight for r in drawn) == 1.0
    again = experience.prioritised_sample(buffer.repartition(5), "id", "priority", 300)
    assert {r.id for r in drawn} == {r.id for r in again.collect()}


def test_small_buffers_are_drawn_with_replacement(spark):
    buffer = spark.createDataFrame([(1, 1.0), (2, 3.0)], "id BIGINT, priority DOUBLE")
    drawn = experience.prioritised_sample(buffer, "id", "priority", 2000, alpha=1.0)
    counts = {r.id: r["count"] for r in drawn.groupBy("id").count().collect()}
    assert sum(counts.values()) == 2000 and 1350 < counts[2] < 1650
    row = drawn.where("id = 1").first()
    assert row.probability == 0.25 and row.weight == 1.0
    assert drawn.where("id = 2").first().weight == pytest.approx((2 * 0.75) ** -0.4 / (2 * 0.25) ** -0.4)


def test_priority_refresh(spark):
    buffer = spark.createDataFrame([(1, 9.0), (2, 9.0), (3, 9.0)], "id BIGINT, priority DOUBLE")
    td = spark.createDataFrame([(1, -0.5, 0.25), (2, 0.0, 0.0), (2, 0.0, 0.0)], "id BIGINT, td_r DOUBLE, td_c DOUBLE")
    got = {r.id: r.priority for r in experience.priority_refresh(buffer, td, "id").collect()}
    assert got == {1: pytest.approx(0.75001), 2: pytest.approx(1e-5), 3: 9.0}


def test_q_sweeps_equal_the_loop(spark):
    rng = random.Random(5)
    log = [(rng.randint(0, 5), rng.randint(0, 3), float(rng.randint(-9, 9)), rng.randint(0, 7), rng.random() < 0.2) for _ in range(400)]
    log = [t for t in log if (t[0], t[1]) != (2, 1)]
    df = spark.createDataFrame(log, "s BIGINT, a BIGINT, r DOUBLE, s2 BIGINT, done BOOLEAN")
    q = {}
    for _ in range(3):
        targets = {}
        for s, a, r, s2, done in log:
            best = max(q.get((s2, b), 0.0) for b in range(4))
            targets.setdefault((s, a), []).append(r + (0.0 if done else 0.98 * best))
        q = {k: q.get(k, 0.0) + 0.3 * (sum(v) / len(v) - q.get(k, 0.0)) for k, v in targets.items()}
    got = {(r.s, r.a): r.q for r in experience.q_sweep(df, 4, sweeps=3).collect()}
    assert got.keys() == q.keys() and all(math.isclose(got[k], q[k], abs_tol=1e-9) for k in q)


def test_greedy_policy(spark):
    q = spark.createDataFrame(
        [(1, 0, 1.0), (1, 1, 2.0), (1, 2, 2.0), (1, 3, 0.0), (2, 0, -1.0), (2, 2, -2.0), (3, 1, 0.0), (4, 3, 0.5)], "s BIGINT, a BIGINT, q DOUBLE"
    )
    states = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 9)], "s BIGINT")
    got = {r.s: r.action for r in experience.greedy_policy(q, 4, states).collect()}
    assert got == {1: 1, 2: 1, 3: 0, 4: 3, 9: 0}
    six = spark.createDataFrame([(1, a, -1.0) for a in range(4)], "s BIGINT, a BIGINT, q DOUBLE")
    assert [r.action for r in experience.greedy_policy(six, 6).collect()] == [4]
    assert [r.action for r in experience.greedy_policy(six, 4).collect()] == [0]


@pytest.mark.parametrize("rate,segment", [(0.0, 64), (1e-6, 64), (0.03, 1 << 16), (0.5, 7), (1.0, 64), (0.003, 4)])
def test_ema_for_any_rate_and_segment(spark, monkeypatch, rate, segment):
    monkeypatch.setattr(experience, "SEGMENT", segment)
    rng = random.Random(8)
    rows = [(k, i, rng.random()) for k in ("a", "b") for i in range(1500 if k == "a" else 3)]
    df = spark.createDataFrame(rows, "k STRING, i BIGINT, c DOUBLE")
    got = {(r.k, r.i): (r.ema, r.dual_weight) for r in experience.ema_dual(df, ["k"], ["i"], "c", rate=rate).collect()}
    for k in ("a", "b"):
        ema, dual = 0.0, 0.1
        for key, i, c in rows:
            if key == k:
                ema = (1 - rate) * ema + rate * c
                dual = max(0.0, dual + 3e-3 * (ema - 0.1))
                assert math.isclose(got[(k, i)][0], ema, abs_tol=1e-9) and math.isclose(got[(k, i)][1], dual, abs_tol=1e-9)
