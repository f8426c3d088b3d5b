"""Mixing sources to target token weights by entropy balancing."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedloom.llm.common import WORD, ranked, staged

_SOURCE = ["has_source", "source_key"]


def source_targets(sources: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Add ``target`` to sources (has_source, source_key, source_size).

    Weights go round the sources by code point, null last; together they share ``share`` of all
    sizes. No target passes ``most`` times its source; what is over goes to the others by weight.
    """
    order = Window.orderBy(F.col("has_source").desc(), "source_key")  # one row per source
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weighed = staged(sources.withColumn("weight", F.get(cycle, turn)).withColumn("cap", F.col("source_size") * float(most)), "weights")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, held = 0.0, -1
    while True:  # each round holds at least one more source at its cap
        full = F.col("cap") <= level * F.col("weight")
        row = weighed.agg(
            F.sum(F.when(full, F.col("cap")).otherwise(0.0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))),
            F.count(F.when(full, 1)),
        ).first()
        if not row[1] or row[2] == held:
            break
        held, level = row[2], (share * total - row[0]) / row[1]
    return weighed.withColumn("target", F.least("cap", level * F.col("weight")))


def tilts(classes: DataFrame, sources: DataFrame, most: float, tolerance: float = 1e-6, rounds: int = 60) -> DataFrame:
    """Solve the dual: one multiplier ``tilt`` per source, rates least(most, exp(tilt * size / scale)).

    Rates start at 1 and keep the largest entropy under the token constraint and the cap. Newton
    steps on the logarithm of the tokens, kept inside a bracket, run for all sources at once; every
    step is one aggregation of ``classes`` (source, size, n). Sources at their cap take ``most``.
    """
    bounds = classes.where("size > 0").groupBy(*_SOURCE).agg(
        (F.sum(F.col("n") * F.col("size") * F.col("size")) / F.sum(F.col("n") * F.col("size"))).alias("scale"),
        F.min("size").alias("least_size"),
    )
    widest = F.col("scale") / F.col("least_size")
    state = sources.join(bounds, _SOURCE).select(
        *_SOURCE, "target", "scale", (F.col("target") >= F.col("cap")).alias("full"),
        F.lit(0.0).alias("tilt"), (-60.0 * widest).alias("low"), (math.log(most) * widest).alias("high"),
    )
    state = staged(state, "tilts")
    rate = F.least(F.lit(float(most)), F.exp(F.col("tilt") * F.col("size") / F.col("scale")))
    for _ in range(rounds):
        words = F.col("n") * F.col("size") * rate
        slope = F.when(rate < most, words * F.col("size") / F.col("scale")).otherwise(0.0)
        sums = classes.join(state, _SOURCE).groupBy(*_SOURCE).agg(F.sum(words).alias("words"), F.sum(slope).alias("slope"))
        now = state.join(sums, _SOURCE)
        error = F.when(F.col("full"), 0.0).otherwise(F.abs(F.col("words") / F.col("target") - 1))
        low = F.when(F.col("words") < F.col("target"), F.col("tilt")).otherwise(F.col("low"))
        high = F.when(F.col("words") < F.col("target"), F.col("high")).otherwise(F.col("tilt"))
        newton = F.col("tilt") + F.log(F.col("target") / F.col("words")) * F.col("words") / F.col("slope")
        good = (F.col("slope") > 0) & (F.col("words") > 0) & (newton > F.col("_low")) & (newton < F.col("_high"))
        step = F.when(good, newton).otherwise((F.col("_low") + F.col("_high")) / 2)
        moved = now.withColumns({"_low": low, "_high": high, "error": error})
        moved = moved.withColumn("tilt", F.when(F.col("error") > tolerance, step).otherwise(F.col("tilt")))
        state = staged(moved.select(*_SOURCE, "target", "scale", "full", "tilt", F.col("_low").alias("low"), F.col("_high").alias("high"), "error"), "tilts")
        if (state.agg(F.max("error")).first()[0] or 0.0) <= tolerance:
            break
        state = state.drop("error")
    return state.select(*_SOURCE, "tilt", "scale", "full")


def rounded(classes: DataFrame, sources: DataFrame, most: int, rounds: int = 12) -> DataFrame:
    """Copies per class (source, size, n, rate) as whole numbers near the target.

    Along falling sizes the running copies are rounded, so errors cancel; then up to ``rounds``
    times each source moves copies of its largest class that still fits what is missing or over.
    """
    along = Window.partitionBy(*_SOURCE).orderBy(F.col("size").desc())
    upto = F.round(F.sum(F.col("n") * F.col("rate")).over(along))
    whole = classes.withColumn("_upto", upto)
    copies = (F.col("_upto") - F.coalesce(F.lag("_upto").over(along), F.lit(0.0))).cast("long")
    state = staged(whole.withColumn("copies", copies).drop("_upto"), "copies")
    for _ in range(rounds):
        sums = state.groupBy(*_SOURCE).agg(F.sum(F.col("copies") * F.col("size")).alias("words"))
        rest = sources.join(sums, _SOURCE).select(*_SOURCE, (F.col("target") - F.col("words")).alias("rest"))
        room = F.when(F.col("rest") > 0, most * F.col("n") - F.col("copies")).otherwise(F.col("copies"))
        fits = state.join(rest, _SOURCE).where((F.col("size") > 0) & (F.col("size") <= F.abs("rest"))).where(room > 0)
        k = F.least(F.floor(F.abs("rest") / F.col("size")), room) * F.signum("rest").cast("long")
        best = fits.groupBy(*_SOURCE).agg(F.max_by(F.struct("size", k.alias("k")), "size").alias("b"))
        moves = staged(best.select(*_SOURCE, F.col("b.size").alias("size"), F.col("b.k").cast("long").alias("k")), "moves")
        if moves.isEmpty():
            break
        added = state.join(moves, [*_SOURCE, "size"], "left")
        state = staged(added.withColumn("copies", F.col("copies") + F.coalesce("k", F.lit(0))).drop("k"), "copies")
    return state


def mix_documents(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: int = 2, carry: Sequence[str] = ()) -> DataFrame:
    """Copies of each document so that every source nears its share of words.

    Returns doc_id, size (words; null text: 0), source_size, target (its source's), copies and taken
    (words with repeats; no document passes ``most`` copies). A null source is one source, last in
    order. Work runs on (source, size) classes: iterations never read the documents again. Which of
    a class's documents get one copy more follows a hash of the id, so reruns agree. Documents
    without words get one copy. An empty table gives no rows; other columns are not read, except those
    in ``carry``: they come along at the end, each row's with its own copies even if ids repeat or are
    null, and the hash is of id and carried columns.
    """
    carried = [docs[c] for c in carry]
    slim = staged(
        docs.select(
            *([F.struct(*carried).alias("_carried"), F.xxhash64(*carried).alias("_digest")] if carry else []),
            docs["doc_id"],
            docs["source"].isNotNull().alias("has_source"),
            F.coalesce(docs["source"], F.lit("")).alias("source_key"),
            F.coalesce(F.regexp_count(docs["text"], F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ),
        "sizes",
    )
    classes = staged(slim.groupBy(*_SOURCE, "size").agg(F.count("*").alias("n")), "classes")
    sources = staged(source_targets(classes.groupBy(*_SOURCE).agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, share, most), "targets")
    solved = tilts(classes, sources, most)
    rate = F.when(F.col("size") == 0, 1.0).when(F.col("full"), float(most)).otherwise(F.least(F.lit(float(most)), F.exp(F.col("tilt") * F.col("size") / F.col("scale"))))
    rated = classes.join(solved, _SOURCE, "left").select(*_SOURCE, "size", "n", F.coalesce(rate, F.lit(1.0)).alias("rate"))
    facts = rounded(rated, sources, most).join(sources.select(*_SOURCE, "source_size", "target"), _SOURCE)
    placed = ranked(slim, [*_SOURCE, "size"], ["doc_id", "_digest"] if carry else ["doc_id"], facts)
    copies = F.expr("copies div n") + F.when(F.col("rank") < F.col("copies") % F.col("n"), 1).otherwise(0)
    out = placed.withColumn("copies", copies.cast("long"))
    return out.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *[F.col("_carried")[c].alias(c) for c in carry])
