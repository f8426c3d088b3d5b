"""Near-duplicate embeddings by a subspace pigeonhole join."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import staged
from feedloom.llm.graph import components
from feedloom.llm.neighbours import unit_rows, usable

#: A little more than the exact budget, so that rounding never loses a pair.
_SLACK = 1e-9


def rotation(dimensions: int, seed: int = 11) -> np.ndarray:
    """A fixed random rotation: spreads every direction over all blocks."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def block_edges(dimensions: int, blocks: int) -> list[int]:
    return [dimensions * i // blocks for i in range(blocks + 1)]


def block_budgets(dimensions: int, blocks: int, threshold: float) -> np.ndarray:
    """Squared-distance budget of each block, in proportion to its dimensions.

    Unit vectors of cosine c are 2 - 2c apart (squared), so a pair at the threshold keeps within
    budget in one block at least.
    """
    return (2 - 2 * threshold + _SLACK) * np.diff(block_edges(dimensions, blocks)) / dimensions


@cache
def geometry(dimensions: int, most_blocks: int, threshold: float) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    """(edges, budgets, rotation, cell widths) for vectors of one length; no block is empty."""
    blocks = min(most_blocks, dimensions)
    budgets = block_budgets(dimensions, blocks, threshold)
    return block_edges(dimensions, blocks), budgets, rotation(dimensions), np.sqrt(budgets + 2 * _SLACK)


def first_block(a: np.ndarray, b: np.ndarray, edges: list[int], budgets: np.ndarray, upto: int) -> np.ndarray:
    """For pairs of rotated rows: whether no block before ``upto`` is within budget."""
    fresh = np.ones(len(a), bool)
    for k in range(upto):
        gap = a[:, edges[k] : edges[k + 1]] - b[:, edges[k] : edges[k + 1]]
        fresh &= (gap * gap).sum(axis=1) > budgets[k]
    return fresh


def linked_pairs(a: np.ndarray, b: np.ndarray, same: bool, turn: np.ndarray, edges: list[int], budgets: np.ndarray, at: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row of a, row of b) of pairs within budget in block ``at`` and in none before, verified exactly.

    ``same``: both sides are one list, each pair counts once.
    """
    ra, rb = a @ turn, b @ turn
    x, y = ra[:, edges[at] : edges[at + 1]], rb[:, edges[at] : edges[at + 1]]
    near = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T) <= budgets[at] + _SLACK
    if same:
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    keep_i, keep_j = [], []
    for s in range(0, len(i), 1 << 16):
        p, q = i[s : s + (1 << 16)], j[s : s + (1 << 16)]
        good = (a[p] * b[q]).sum(axis=1) >= threshold
        p, q = p[good], q[good]
        fresh = first_block(ra[p], rb[q], edges, budgets, at)
        keep_i.append(p[fresh])
        keep_j.append(q[fresh])
    return (np.concatenate(keep_i), np.concatenate(keep_j)) if keep_i else (i, j)


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest node of each node's component, by label passing with shortcuts."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        after = label.copy()
        np.minimum.at(after, label[i], low)
        np.minimum.at(after, label[j], low)
        after = after[after]
        if (after == label).all():
            break
        label = after
    return label


def near_embeddings(vectors: DataFrame, threshold: float = 0.93, blocks: int = 4, chunk: int = 1024) -> DataFrame:
    """Links between vectors (vec_id, embedding, label) of one label with cosine >= threshold.

    Returns per row vec_id, n_links (other rows linked directly), component_id (smallest vec_id
    reachable, itself included) and kept (vec_id = component_id). Null labels, null ids, and vectors
    that are null, zero or hold null or non-finite components, link with nothing. Equal vectors of a label
    are joined once and count as often as they occur. A label may be of any type that groups; only
    vectors of one length are compared. No vectors, no rows; other columns are not read.

    Rotated unit vectors are cut into ``blocks``; each block is joined by ranges on a grid over its
    first two coordinates, cells as wide as the block's radius, so partners lie in the same or a
    touching cell. Full cells are dealt into chunks of about ``chunk`` rows and chunk pairs are single
    tasks' work. A pair within budget in several blocks counts in the first. Tasks return counts and
    one edge per linked vector, never all pairs.
    """
    ids = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"].cast("array<double>").alias("embedding"), vectors["label"].cast("string").alias("label"))
    ids = ids.withColumn("label", F.concat("label", F.lit("/"), F.size("embedding")))
    fine = usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    groups = staged(ids.where(fine).groupBy("label", "embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")), "vectors")

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for dimensions, some in frame.groupby(frame["embedding"].map(len)):
                edges, _, turn, widths = geometry(int(dimensions), blocks, threshold)
                rotated = unit_rows(some["embedding"]) @ turn
                for k, width in enumerate(widths):
                    x = np.floor(rotated[:, edges[k]] / width)
                    y = np.floor(rotated[:, min(edges[k] + 1, edges[k + 1] - 1)] / width)
                    yield some[["label", "node"]].assign(block=k, x=x.astype(np.int64), y=y.astype(np.int64))

    placed = staged(groups.select("label", "node", "embedding").mapInPandas(cells, "label string, node long, block int, x long, y long"), "cells")
    cell = ["label", "block", "x", "y"]
    sizes = placed.groupBy(*cell).agg(F.ceil(F.count("*") / chunk).cast("int").alias("chunks"))
    # partners of a cell: itself and four of its eight neighbours, so that each pair of cells meets once
    steps = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in ((0, 0), (1, -1), (1, 0), (1, 1), (0, 1))])
    toward = sizes.withColumn("s", F.explode(steps)).select(
        *cell, "chunks", F.col("s.dx").alias("dx"), F.col("s.dy").alias("dy"), (F.col("x") + F.col("s.dx")).alias("x2"), (F.col("y") + F.col("s.dy")).alias("y2")
    )
    other = sizes.select("label", "block", F.col("x").alias("x2"), F.col("y").alias("y2"), F.col("chunks").alias("chunks2"))
    meets = staged(toward.join(other, ["label", "block", "x2", "y2"]), "meetings")
    part = lambda chunks: F.pmod(F.xxhash64("node"), F.col(chunks)).cast("int")
    upto = lambda low, n: F.explode(F.sequence(low, F.col(n) - 1))
    key = ["label", "block", "x", "y", "dx", "dy", "i", "j"]
    at_home = placed.join(meets, cell).withColumn("i", part("chunks"))
    left = at_home.withColumn("j", upto(F.when((F.col("dx") == 0) & (F.col("dy") == 0), F.col("i")).otherwise(0), "chunks2")).select(*key, "node", F.lit(True).alias("left"))
    guests = placed.withColumnsRenamed({"x": "x2", "y": "y2"}).join(meets, ["label", "block", "x2", "y2"]).withColumn("j", part("chunks2"))
    inner = (F.col("dx") == 0) & (F.col("dy") == 0)
    last = F.when(inner, F.col("j") - 1).otherwise(F.col("chunks") - 1)
    right = guests.where(~inner | (F.col("j") > 0)).withColumn("i", F.explode(F.sequence(F.lit(0), last))).select(*key, "node", F.lit(False).alias("left"))
    dealt = left.unionByName(right).join(groups, ["label", "node"])

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        first = frame.iloc[0]
        a = frame[frame["left"]].sort_values("node")
        same = bool(first["dx"] == 0 and first["dy"] == 0 and first["i"] == first["j"])
        b = a if same else frame[~frame["left"]].sort_values("node")
        if not len(a) or not len(b):
            return pd.DataFrame({"node": [], "links": [], "root": []})
        edges, budgets, turn, _ = geometry(len(a["embedding"].iloc[0]), blocks, threshold)
        i, j = linked_pairs(unit_rows(a["embedding"]), unit_rows(b["embedding"]), same, turn, edges, budgets, int(first["block"]), threshold)
        nodes = np.concatenate([a["node"].to_numpy(), b["node"].to_numpy()])
        names, index = np.unique(nodes, return_inverse=True)
        i, j = index[i], index[len(a) + j]
        copies = np.zeros(len(names), np.int64)
        copies[index] = np.concatenate([a["copies"].to_numpy(), b["copies"].to_numpy()])
        links = np.bincount(i, copies[j], len(names)) + np.bincount(j, copies[i], len(names))
        some = links > 0
        return pd.DataFrame({"node": names[some], "links": links[some].astype(np.int64), "root": names[roots(len(names), i, j)][some]})

    found = staged(dealt.groupBy(*key).applyInPandas(join, "node long, links long, root long"), "links")
    totals = found.groupBy("node").agg(F.sum("links").alias("links"))
    tops = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = groups.join(totals, "node", "left").join(tops, F.col("node") == F.col("id"), "left")
    known = known.select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("component_id"))
    usable_key = F.when(fine, F.col("label"))
    out = ids.withColumn("_label", usable_key).join(known.withColumnRenamed("label", "_label"), ["_label", "embedding"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
