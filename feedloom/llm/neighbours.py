"""Approximate nearest neighbours by collision counting over query-centred hash windows."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedloom.llm.common import staged


def usable(vector: Column) -> Column:
    """Not null, not all zero, no null or non-finite component."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit_rows(vectors: pd.Series) -> np.ndarray:
    """The vectors in double precision, scaled to length 1."""
    rows = np.stack([np.asarray(v, np.float64) for v in vectors])
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def sure_width(axes: int, need: int, sigma: float) -> float:
    """Window (each side) per unit of distance at which a row collides on ``need`` of the axes with
    ``sigma`` standard deviations to spare: projections differ by a normal of that distance."""
    low, high = 0.0, 1.0
    for _ in range(60):
        rate = (low + high) / 2
        enough = rate * axes - sigma * math.sqrt(axes * rate * (1 - rate)) >= need
        low, high = (low, rate) if enough else (rate, high)
    return NormalDist().inv_cdf(min(1 - 1e-12, (1 + high) / 2))


def search_block(base: np.ndarray, queries: np.ndarray, k: int, axes: np.ndarray, frequent: float, sigma: float, first_width: float, growth: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the (rows, cosines) verified in one block.

    Every axis keeps its projections sorted. A query's window starts at ``first_width`` on each side
    of its own projection and grows by ``growth`` (virtual rehashing: wider buckets of the same
    hash); only the new margins are counted. Rows that have collided on at least ``frequent`` of
    the axes are verified once. The search ends when a row as near as the k-th best would have
    reached that count with ``sigma`` standard deviations to spare, or all rows were verified;
    no window grows beyond what that asks for.
    """
    m, n = axes.shape[1], len(base)
    need = math.ceil(frequent * m)
    per_distance = sure_width(m, need, sigma)
    projected = base @ axes
    order = np.argsort(projected, axis=0, kind="stable").T.copy()
    lines = np.take_along_axis(projected.T, order, axis=1)
    out = []
    for q, at in zip(queries, queries @ axes):
        counts = np.zeros(n, np.int64)
        done = np.zeros(n, bool)
        rows, cosines = np.zeros(0, np.int64), np.zeros(0)
        low = np.array([np.searchsorted(line, x) for line, x in zip(lines, at)])
        high, width = low.copy(), first_width
        while True:
            margins = []
            for j in range(m):
                left, right = lines[j].searchsorted((at[j] - width, at[j] + width))
                margins += [order[j, left : low[j]], order[j, high[j] : right]]
                low[j], high[j] = left, right
            counts += np.bincount(np.concatenate(margins), minlength=n)
            fresh = np.flatnonzero((counts >= need) & ~done)
            done[fresh] = True
            rows = np.concatenate([rows, fresh])
            cosines = np.concatenate([cosines, base[fresh] @ q])
            if len(rows) == n:
                break
            if len(rows) > k:  # the query itself may be among them
                kth = np.partition(cosines, len(cosines) - k - 1)[len(cosines) - k - 1]
                enough = per_distance * math.sqrt(max(1e-12, 2 - 2 * kth))
                if width >= enough:
                    break
                width = min(width * growth, enough)
            else:
                width *= growth
        out.append((rows, cosines))
    return out


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, axes: int = 64, frequent: float = 0.6, sigma: float = 1.0, block: int = 32768, query_block: int = 256, seed: int = 7) -> DataFrame:
    """The ``k`` nearest rows (vec_id, embedding) by cosine for each query row, others than itself.

    Returns query_id, rank (from 1; ties to the smaller id), vec_id and score (the cosine of the
    original vectors in double precision). Vectors that are null, zero or hold null or non-finite
    components, and rows without an id, take no part; fewer candidates than ``k`` are all returned.
    Only vectors of one length are compared. Rows equal in id and vector are searched once and count
    as often as they occur: each of them, if a query, has its own ``k`` rows, its copies among them.
    A row that shares only the id is a candidate like any other.

    Rows and queries are dealt into blocks of bounded size by a hash of the id and each (rows,
    queries) block pair is one task's work: every row is indexed, none is gathered or broadcast. The
    axes are random lines, so nothing is fitted. No vectors, no rows.
    """
    asks = F.coalesce(is_query, F.lit(False))
    known = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"], asks.alias("asks"))
    known = known.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    counted = known.groupBy("vec_id", "embedding").agg(F.count("*").alias("copies"), F.count_if("asks").alias("asks"))
    rows = staged(counted.withColumns({"digest": F.xxhash64("vec_id", "embedding"), "length": F.size("embedding")}), "vectors")
    n, n_queries = rows.agg(F.count("*"), F.count_if(F.col("asks") > 0)).first()
    blocks, query_blocks = max(1, -(-n // block)), max(1, -(-n_queries // query_block))
    deal = lambda kinds, salt: F.pmod(F.xxhash64("vec_id", "embedding", F.lit(salt)), F.lit(kinds)).cast("int")
    every = lambda kinds: F.explode(F.sequence(F.lit(0), F.lit(kinds - 1)))
    facts = ["vec_id", "embedding", "digest", "length"]
    base = rows.select(*facts, "copies", deal(blocks, 1).alias("b"), every(query_blocks).alias("q"))
    asked = rows.where("asks > 0").select(*facts, "asks", deal(query_blocks, 2).alias("q")).withColumn("b", every(blocks))
    shape = "query_id long, query_digest long, asks long, vec_id long, score double, copies long"

    def search(some: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, int, int, float, int]] = []
        if len(some) and len(queries):
            order = ["vec_id", "digest"]
            some, queries = some.sort_values(order, kind="stable"), queries.sort_values(order, kind="stable")
            ids, digests, copies = (some[c].to_numpy() for c in ("vec_id", "digest", "copies"))
            units, points = unit_rows(some["embedding"]), unit_rows(queries["embedding"])
            lines = np.random.default_rng(seed).standard_normal((units.shape[1], axes))
            searched = search_block(units, points, k, lines, frequent, sigma, 0.1, 2.0)
            for query, digest, asks, point, (at, cosines) in zip(queries["vec_id"], queries["digest"], queries["asks"], points, searched):
                left = copies[at] - ((ids[at] == query) & (digests[at] == digest))  # all but the query's own row
                at, cosines, left = at[left > 0], cosines[left > 0], left[left > 0]
                if len(at) > k:  # what can be among the best, measured anew so that ties are exact
                    good = cosines >= np.partition(cosines, len(at) - k)[len(at) - k] - 1e-9
                    at, left = at[good], left[good]
                exact = (units[at] * point).sum(axis=1)
                for i in np.lexsort((ids[at], -exact))[:k]:
                    found.append((int(query), int(digest), int(asks), int(ids[at[i]]), float(exact[i]), min(k, int(left[i]))))
        return pd.DataFrame(found, columns=["query_id", "query_digest", "asks", "vec_id", "score", "copies"])

    keys = ["length", "b", "q"]
    pairs = base.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(search, shape)
    each = pairs.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    order = Window.partitionBy("query_id", "query_digest").orderBy(F.col("score").desc(), "vec_id")
    best = each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    repeated = best.withColumn("ask", F.explode(F.sequence(F.lit(1).cast("long"), F.col("asks"))))
    return repeated.select("query_id", "rank", "vec_id", "score")


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact neighbours (query_id, vec_id) that were found."""
    hits = exact.join(found, ["query_id", "vec_id"], "left_semi").count()
    return hits / max(1, exact.count())
