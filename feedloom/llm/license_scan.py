"""License scan: MinHash bands over overlapping windows retrieve templates, exact containment decides."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import staged

_OTHER = r"[^\p{L}\p{N}]+"


def word_list(text: Column) -> Column:
    """Lower-case words of letters and digits; null: none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _OTHER), lambda w: w != "")


def plain_words(text: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def shingle_hashes(words: Column, width: int) -> Column:
    """Hash per word position of the ``width`` words from there on; fewer words are one shingle."""
    n = F.size(words)
    at = F.when(n > 0, F.sequence(F.lit(1), F.greatest(F.lit(1), n - (width - 1))))
    return F.transform(F.coalesce(at, F.array().cast("array<int>")), lambda i: F.xxhash64(F.slice(words, i, width)))


@dataclass(frozen=True)
class Bands:
    """MinHash of ``bands`` bands of one value: two sets of similarity s share a band with
    probability 1 - (1 - s) ** bands."""

    bands: int

    def collision(self, similarity: float) -> float:
        return 1 - (1 - similarity) ** self.bands

    @staticmethod
    def for_similarity(similarity: float, miss: float) -> Bands:
        return Bands(math.ceil(math.log(miss) / math.log(1 - similarity)))

    def columns(self, shingle: Column) -> list[Column]:
        """Aggregates, one per band."""
        return [F.min(F.xxhash64(shingle, F.lit(k))).alias(f"m{k}") for k in range(self.bands)]

    def marks(self) -> Column:
        """One hash per band, from the aggregates."""
        return F.array(*[F.xxhash64(F.lit(k), F.col(f"m{k}")) for k in range(self.bands)])


def _classes(templates: Sequence[tuple[str, str]], width: int) -> dict[int, list[tuple[str, str]]]:
    """Templates by size: the power of two their words fit in."""
    out: dict[int, list[tuple[str, str]]] = {}
    for name, text in templates:
        if words := plain_words(text):
            out.setdefault(1 << max(3, (max(len(words), width) - 1).bit_length()), []).append((name, text))
    return out


def telling_words(templates: Sequence[tuple[str, str]], width: int, containment: float) -> list[str]:
    """Words of which every match holds one: without them, too few shingles of a template are left.

    Long words are taken first; texts with none of them can't contain any template.
    """
    out: set[str] = set()
    for _, text in templates:
        words = plain_words(text)
        places = [words[i : i + width] for i in range(max(1, len(words) - width + 1))]
        distinct = {tuple(p) for p in places}
        while sum(not out & set(p) for p in distinct) >= containment * len(distinct):
            out.add(max((w for p in distinct if not out & set(p) for w in p), key=lambda w: (len(w), w)))
    return sorted(out)


def scan_licenses(docs: DataFrame, templates: Sequence[tuple[str, str]], width: int = 5, containment: float = 0.8, similarity: float = 0.25, miss: float = 1e-4) -> DataFrame:
    """Templates (name, text) found in documents (doc_id, text).

    Returns one row per document and template: doc_id, license, containment (largest share of the
    template's distinct shingles in one window), n_windows (windows that reach ``containment``) and
    first_word (where the first of them begins). Documents without a match give no row, so null and
    empty texts don't either; repeated rows of an id count together; other columns are not read.

    Templates are grouped by length L (a power of two); windows of 2L words begin every L words, so
    any L words lie whole in one. A window counts only shingles that occur in templates of its group,
    which changes no containment but brings a match's similarity near 1: unless further templates of
    the group share the window, it is at least the containment. Bands of one value are so many that
    a similarity of ``similarity`` is missed with probability ``miss`` at most.
    """
    spark: SparkSession = docs.sparkSession
    bands = Bands.for_similarity(similarity, miss)
    words = telling_words(templates, width, containment)
    lowered = F.lower(docs["text"])
    may = reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(w)) for w in words], F.lit(False))
    tokens = docs.where(may).select(docs["doc_id"].alias("doc_id"), F.monotonically_increasing_id().alias("row"), word_list(docs["text"]).alias("words"))
    shingled = tokens.select("doc_id", "row", F.posexplode(shingle_hashes(F.col("words"), width)).alias("pos", "shingle"))

    groups = [(size, name, text) for size, group in _classes(templates, width).items() for name, text in group]
    table = spark.createDataFrame(groups, "size int, license string, body string")
    parts = table.select("size", "license", F.explode(F.array_distinct(shingle_hashes(word_list(F.col("body")), width))).alias("shingle"))
    known = parts.select("size", "shingle").distinct()
    hits = staged(shingled.join(F.broadcast(known), "shingle"), "license-hits")  # templates are a short fixed list
    slot = F.expr("pos div size").cast("long")
    windows = hits.select("doc_id", "row", "size", "shingle", F.explode(F.array(slot, slot - 1)).alias("window")).where("window >= 0").distinct()
    keys = ["doc_id", "row", "size", "window"]
    signed = windows.groupBy(*keys).agg(*bands.columns(F.col("shingle"))).select(*keys, F.explode(bands.marks()).alias("band"))
    targets = parts.groupBy("size", "license").agg(F.count("*").alias("n"), *bands.columns(F.col("shingle")))
    targets = targets.select("size", "license", "n", F.explode(bands.marks()).alias("band"))
    candidates = signed.join(F.broadcast(targets), ["size", "band"]).select(*keys, "license", "n").distinct()

    place = ["row", "size", "window"]
    inside = candidates.join(windows.drop("doc_id"), place)
    matched = inside.join(F.broadcast(parts), ["size", "license", "shingle"]).groupBy(*keys, "license", "n").agg(F.count("*").alias("common"))
    good = matched.where(F.col("common") >= F.lit(containment) * F.col("n"))
    return good.groupBy("doc_id", "license").agg(
        F.max(F.col("common") / F.col("n")).alias("containment"),
        F.count("*").alias("n_windows"),
        F.min(F.col("window") * F.col("size")).alias("first_word"),
    )
