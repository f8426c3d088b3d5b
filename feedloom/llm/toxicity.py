"""Toxicity: sparse logistic regression with a counterfactual penalty on identity terms."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import text_batches
from feedloom.llm.wordhash import mix, range_hashes, text_chunks, word_ranges

#: Identity terms; each is swapped with the others of its line.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "latino"),
    ("immigrants", "natives", "refugees", "foreigners"),
    ("disabled", "blind", "deaf"),
    ("old", "young"),
)
#: Hash buckets of the features; a model is that many doubles and a bias.
DIMENSIONS = 1 << 18
#: Leading bytes of a word that count as features beside the whole word.
PREFIXES = (4, 5, 6)

_BREAK = np.array([not (48 <= b <= 57 or 97 <= b <= 122 or 65 <= b <= 90 or b >= 128) for b in range(256)])


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # DIMENSIONS values
    bias: float


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket): words and word beginnings that occur in each row, once each."""
    row, starts, ends = word_ranges(data, offsets, _BREAK)
    rows, buckets = [row], [range_hashes(data, starts, ends)]
    for n in PREFIXES:
        some = np.flatnonzero(ends - starts > n)
        rows.append(row[some])
        buckets.append(mix(range_hashes(data, starts[some], starts[some] + n) + np.uint64(n)))
    key = np.concatenate(rows) * DIMENSIONS + (np.concatenate(buckets) % np.uint64(DIMENSIONS)).astype(np.int64)
    key.sort()
    key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
    return key // DIMENSIONS, key % DIMENSIONS


def swapped(text: str) -> str:
    """The text with every identity term replaced by the next of its line."""
    after = {t: line[(i + 1) % len(line)] for line in IDENTITY_TERMS for i, t in enumerate(line)}
    return re.sub(r"\b(" + "|".join(after) + r")\b", lambda m: after[m[0]], text)


def _lowered(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text", F.lower(F.coalesce(docs["text"], F.lit(""))))


def training_rows(labelled: DataFrame, most: int) -> DataFrame:
    """(label, found, other): features (32-bit) of labelled texts and of their swapped versions (null: same).

    A bounded sample of at most ``most`` rows (text, label), those of smallest hash.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lists(texts: list[str]) -> list[np.ndarray]:
            out = []
            for _, data, offsets in text_chunks(pa.array(texts, pa.large_string())):
                row, bucket = features(data, offsets)
                out += np.split(bucket, np.searchsorted(row, np.arange(1, len(offsets) - 1)))
            return out

        for batch in batches:
            texts = batch.column(0).to_pylist()
            others = [swapped(t) for t in texts]
            changed = [i for i, (t, o) in enumerate(zip(texts, others)) if t != o]
            other: list = [None] * len(texts)
            for i, found in zip(changed, lists([others[i] for i in changed])):
                other[i] = found
            columns = ([None if x is None else x.astype(np.int32).tobytes() for x in kind] for kind in (lists(texts), other))
            yield pa.RecordBatch.from_arrays([batch.column(1), *(pa.array(c, pa.binary()) for c in columns)], ["label", "found", "other"])

    rows = _lowered(labelled).select("text", F.col("label").cast("int").alias("label")).where("label is not null")
    some = rows.orderBy(F.xxhash64("text", "label"), "text", "label").limit(most)
    return some.mapInArrow(extract, "label int, found binary, other binary")


def fit(examples: list[tuple[int, np.ndarray, np.ndarray | None]], sparsity: float = 3e-4, fairness: float = 1.0, rounds: int = 150) -> Model:
    """Balanced logistic loss + sparsity * |w| + fairness * mean squared score change under swaps, w >= 0.

    With ``fairness``, labels are balanced among texts with an identity term and among others apart:
    the penalty alone would lift all terms of a line to the most blamed one.

    Solved by accelerated proximal gradient. A text's score is its bias plus the weights of what
    occurs in it. No weight is negative: harmless words don't make up for a toxic phrase, however
    many there are, and what the penalty takes from identity terms can't come back as a bonus of other
    words; the sparse weights keep long clean texts near the bias. With one class only, every text
    gets that label; without examples, 0.5.
    """
    labels = np.array([y for y, _, _ in examples], float)
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(DIMENSIONS), 0.0 if not len(labels) else (20.0 if labels[0] else -20.0))
    row = np.repeat(np.arange(len(labels), dtype=np.int32), [len(f) for _, f, _ in examples])
    column = np.concatenate([f for _, f, _ in examples])
    moves = [(np.setdiff1d(f, o), np.setdiff1d(o, f)) for _, f, o in examples if o is not None]
    swap = np.repeat(np.arange(len(moves)), [len(a) + len(b) for a, b in moves])
    swap_column = np.concatenate([np.concatenate(m) for m in moves]) if moves else np.zeros(0, np.int64)
    sign = np.concatenate([np.repeat([1.0, -1.0], [len(a), len(b)]) for a, b in moves]) if moves else np.zeros(0)
    often = np.bincount(column, minlength=DIMENSIONS) > 1  # what occurs in one example teaches nothing general
    row, column = row[often[column]], column[often[column]]
    used = np.union1d(column, swap_column)
    column, swap_column = (np.searchsorted(used, c).astype(np.int32) for c in (column, swap_column))
    balance = np.where(labels > 0.5, 0.5 / labels.sum(), 0.5 / (1 - labels).sum())
    mention = np.array([o is not None for _, _, o in examples])
    cells = np.bincount(2 * mention + (labels > 0.5), minlength=4)
    if fairness and cells.all():
        # Texts with and without identity terms get both labels in equal shares, so a mention tells nothing.
        share = np.array([1 - mention.mean(), mention.mean()])[mention.astype(int)]
        balance = 0.5 * share / cells[2 * mention + (labels > 0.5)]
    # Own step lengths for swapped terms, so that a strong penalty does not slow the others down.
    lengths = np.bincount(swap, minlength=len(moves))[swap] if moves else swap
    bend = np.bincount(swap_column, 2 * fairness / max(1, len(moves)) * lengths, len(used))
    weights, bias = np.zeros(len(used)), 0.0
    ahead, ahead_bias, pace, step = weights, bias, 1.0, 1.0

    def loss_and_slope(w: np.ndarray, b: float) -> tuple[float, np.ndarray, float]:
        z = np.bincount(row, w[column], len(labels)) + b
        loss = (balance * (np.logaddexp(0, z) - labels * z)).sum()
        gap = balance * (1 / (1 + np.exp(-np.clip(z, -60, 60))) - labels)
        slope = np.bincount(column, gap[row], len(used))
        if moves:
            change = np.bincount(swap, sign * w[swap_column], len(moves))
            loss += fairness * (change**2).mean()
            slope += np.bincount(swap_column, 2 * fairness / len(moves) * sign * change[swap], len(used))
        return loss, slope, gap.sum()

    for _ in range(rounds):
        loss, slope, bias_slope = loss_and_slope(ahead, ahead_bias)
        while True:  # shorten the step until the quadratic bound holds
            bent = 1 / step + bend
            fresh = np.maximum(ahead - (slope + sparsity) / bent, 0)
            fresh_bias = ahead_bias - step * bias_slope
            delta, delta_bias = fresh - ahead, fresh_bias - ahead_bias
            bound = loss + delta @ slope + delta_bias * bias_slope + (delta**2 @ bent + delta_bias**2 / step) / 2
            if loss_and_slope(fresh, fresh_bias)[0] <= bound + 1e-12:
                break
            step /= 2
        following = (1 + (1 + 4 * pace * pace) ** 0.5) / 2
        ahead = fresh + (pace - 1) / following * (fresh - weights)
        ahead_bias = fresh_bias + (pace - 1) / following * (fresh_bias - bias)
        weights, bias, pace = fresh, fresh_bias, following
        step *= 1.1
    full = np.zeros(DIMENSIONS)
    full[used] = weights
    return Model(full, float(bias))


def train(labelled: DataFrame, most: int = 4000, **options) -> Model:
    """Fit on at most ``most`` of the labelled rows (text, label 0 or 1; null labels don't count).

    The bounded sample is one task's work; the driver gets the weights that are not 0.
    """

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = lambda x: None if x is None else np.frombuffer(x, np.int32)
        columns = (zip(*(batch.column(c).to_pylist() for c in ("label", "found", "other"))) for batch in batches)
        model = fit([(label, array(found), array(other)) for rows in columns for label, found, other in rows], **options)
        used = np.flatnonzero(model.weights)
        values = np.concatenate([[model.bias], model.weights[used]])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1], used])), pa.array(values)], ["bucket", "weight"])

    weights, bias = np.zeros(DIMENSIONS), 0.0
    for r in training_rows(labelled, most).coalesce(1).mapInArrow(fitted, "bucket long, weight double").collect():
        if r["bucket"] < 0:
            bias = r["weight"]
        else:
            weights[r["bucket"]] = r["weight"]
    return Model(weights, bias)


def score_texts(docs: DataFrame, model: Model, names: list[str] | None = None) -> DataFrame:
    """Add ``score`` (0 to 1) of each whole text to the columns ``names`` (default doc_id)."""
    text_batches(docs.sparkSession)
    names = names or ["doc_id"]
    weights = model.weights.astype(np.float32)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("_lowered")
            scores = []
            for _, data, offsets in text_chunks(batch.column(at)):
                row, bucket = features(data, offsets)
                scores.append(np.bincount(row, weights[bucket], len(offsets) - 1) + model.bias)
            z = np.concatenate(scores) if scores else np.zeros(0)
            columns = [batch.column(i) for i in range(batch.num_columns) if i != at]
            kept = [n for i, n in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(1 / (1 + np.exp(-np.clip(z, -60, 60))))], [*kept, "_score"])

    slim = docs.select(*[docs[n] for n in names], F.lower(F.coalesce(docs["text"], F.lit(""))).alias("_lowered"))
    schema = docs.select(*[docs[n] for n in names]).withColumn("_score", F.lit(0.0)).schema
    return slim.mapInArrow(add, schema)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def train_on(docs: DataFrame, labels: DataFrame, most: int = 4000) -> Model:
    """Train on documents joined with ``labels`` (doc_id, toxic), held-out ids left aside.

    Only ids and labels are shuffled until the bounded choice of ids is made.
    """
    known = labels.select("doc_id", F.col("toxic").alias("label")).where("label is not null").where(~held_out(F.col("doc_id")))
    chosen = known.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(most)
    return train(docs.select("doc_id", "text").join(chosen, "doc_id").select("text", "label"), most)


def toxicity(docs: DataFrame, labels: DataFrame, most: int = 4000) -> DataFrame:
    """Score every whole text of ``docs`` (doc_id, text).

    Returns doc_id, held_out, score (higher: likelier label 1; null and empty texts get the bias
    alone) and predicted (1 from 0.5 on). The model is fitted on at most ``most`` labelled documents;
    scoring covers all rows and reads nothing but the text. No documents, no rows.
    """
    scored = score_texts(docs, train_on(docs, labels, most))
    predicted = (F.col("_score") >= 0.5).cast("int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"), predicted.alias("predicted"))
