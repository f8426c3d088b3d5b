"""URL filter: host and path rules, else logistic regression on hashed character n-grams."""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Hash buckets of the n-grams; the weights are as many doubles.
DIMENSIONS = 1 << 15
GRAMS = (3, 4, 5)


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://`` up to ``/ ? #``, ASCII lower case; then up to ``? #``.

    Null, or without ``://``: both empty.
    """
    text = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(text, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def rule_columns(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule (verdict, host, path) that fits, else nulls.

    The rules are a short list of the caller's, held in the expression.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for word, at, below in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(below)
        rule, verdict = F.when(fits, at + below).otherwise(rule), F.when(fits, word).otherwise(verdict)
    return rule, verdict


def grams(host: str, path: str) -> np.ndarray:
    """Hashed n-grams of ``^host$`` and ``^path$``, each kind in buckets of its own."""
    found = set()
    for mark, part in (("h", host), ("p", path)):
        part = f"^{part}$"
        for n in GRAMS:
            found.update(f"{mark}{part[i : i + n]}" for i in range(len(part) - n + 1))
    return np.fromiter((zlib.crc32(g.encode("utf-8", "surrogatepass")) % DIMENSIONS for g in found), np.int64, len(found))


def fit(rows: Sequence[tuple[str, str, int]], rounds: int = 200, ridge: float = 1e-3) -> np.ndarray:
    """Weights (the last is the bias) of L2-regularised logistic regression over unit-length grams.

    Both classes weigh alike, however many examples each has. Without examples all weights are 0. Nothing here depends on chance.
    """
    weights = np.zeros(DIMENSIONS + 1)
    if not rows:
        return weights
    lists = [grams(h, p) for h, p, _ in rows]
    labels = np.array([y for _, _, y in rows], float)
    share = np.where(labels > 0.5, labels.mean(), 1 - labels.mean())
    balance = 0.5 / share / len(lists)
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    column = np.concatenate(lists)
    value = 1 / np.sqrt(np.maximum(1, [len(x) for x in lists]))[row]
    previous, momentum = weights.copy(), weights.copy()
    for k in range(rounds):  # accelerated gradient; rows have length sqrt(2), so the step is safe
        z = np.bincount(row, momentum[column] * value, len(lists)) + momentum[-1]
        gap = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - labels) * balance
        gradient = np.append(np.bincount(column, gap[row] * value, DIMENSIONS) + ridge * momentum[:-1], gap.sum())
        previous, weights = weights, momentum - 2.0 * gradient
        momentum = weights + (k / (k + 3)) * (weights - previous)
    return weights


def score(host: str, path: str, weights: np.ndarray) -> float:
    found = grams(host, path)
    z = weights[found].sum() / max(1, len(found)) ** 0.5 + weights[-1]
    return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def labelled_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]], most: int = 4000) -> DataFrame:
    """A small labelled table (url, label; 1: block): at most ``most`` distinct urls that a rule decides.

    They are those of smallest hash, so any size of input gives an even, repeatable choice.
    """
    host, path = url_parts(pages["url"])
    verdict = rule_columns(host, path, rules)[1]
    decided = pages.select(pages["url"], (verdict == "block").cast("int").alias("label")).where(F.col("label").isNotNull())
    return decided.distinct().orderBy(F.xxhash64("url"), "url").limit(most)


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]], labelled: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Add a verdict to every url of ``pages`` (page_id, url).

    Returns page_id, host, path, rule, score (of the method, 0 to 1, higher: block) and verdict (the
    rule's; else block from ``threshold`` on). ``labelled`` (url, label) is a small table that the
    driver reads whole. Null urls have empty host and path and are scored like any other; other
    columns are not read.
    """
    host, path = url_parts(labelled["url"])
    examples = [tuple(r) for r in labelled.where(F.col("label").isNotNull()).select(host, path, "label").collect()]
    weights = fit(sorted(examples))

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            yield frame.assign(score=[score(h, p, weights) for h, p in zip(frame["host"], frame["path"])])

    host, path = url_parts(pages["url"])
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    split = pages.select(pages["page_id"], host.alias("host"), path.alias("path"))
    schema = T.StructType([*split.schema.fields, T.StructField("score", T.DoubleType())])
    scored = split.mapInPandas(add, schema)
    by_method = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", rule.alias("rule"), "score", F.coalesce(verdict, by_method).alias("verdict"))
