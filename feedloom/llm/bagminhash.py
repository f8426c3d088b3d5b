"""Near-duplicate documents by BagMinHash: weighted Jaccard over multisets of word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedloom.llm.common import staged, text_batches
from feedloom.llm.graph import components
from feedloom.llm.wordhash import counted, mix, shingles, text_chunks

_DRAW, _PLACE, _COPY = (np.uint64(x) for x in (0xD1342543DE82EF95, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))


def bag_signatures(owner: np.ndarray, element: np.ndarray, count: np.ndarray, rows: int, registers: int) -> np.ndarray:
    """Registers (rows x registers) of smallest arrival times; inf where a row has no element.

    Every element owns a Poisson process over weight and time, cut into the dyadic weight blocks
    [0,1), [1,2), [2,4), ...: a row of count c sees the arrivals whose weight lies below c, the weight of
    an arrival being found by halving its block bit by bit. An arrival falls into one register. Two
    rows agree in a register with probability of their weighted Jaccard similarity. An element stops
    once its next arrival is later than all its row's registers.
    """
    own, seed, base = [owner], [mix(element)], [np.zeros(len(owner))]
    length, weight = [np.ones(len(owner))], [count.astype(float)]
    block = 1
    while len(some := np.flatnonzero(count > (1 << (block - 1)))):
        own.append(owner[some])
        seed.append(mix(element[some] ^ (np.uint64(block) << np.uint64(56))))
        base.append(np.full(len(some), float(1 << (block - 1))))
        length.append(base[-1])
        weight.append(count[some].astype(float))
        block += 1
    own, seed, base, length, weight = (np.concatenate(x) for x in (own, seed, base, length, weight))
    best = np.full(rows * registers, np.inf)
    time, drawn = np.zeros(len(own)), 0
    while len(own):
        draws = max(1, min(32, 16384 // len(own)))  # many at once when few processes are left
        numbers = np.arange(drawn, drawn + draws, dtype=np.uint64) * _DRAW
        bits = mix(seed[:, None] + numbers[None, :])
        gaps = -np.log(((bits >> np.uint64(11)) + np.uint64(1)) * 2.0**-53) / length[:, None]
        times = time[:, None] + np.cumsum(gaps, axis=1)
        bits = mix(bits ^ _PLACE)
        register = ((bits >> np.uint64(32)) * np.uint64(registers)) >> np.uint64(32)
        level = base[:, None] + length[:, None] * ((bits & np.uint64(0xFFFFFFFF)) * 2.0**-32)
        latest = best.reshape(rows, registers).max(axis=1)
        useful = (times < latest[own][:, None]) & (level < weight[:, None])
        at = (own[:, None] * registers + register.astype(np.int64))[useful]
        np.minimum.at(best, at, times[useful])
        latest = best.reshape(rows, registers).max(axis=1)
        live = times[:, -1] < latest[own]
        own, seed, base, length, weight, time = (x[live] for x in (own, seed, base, length, weight, times[:, -1]))
        drawn += draws
    return best.reshape(rows, registers)


def band_hashes(registers: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash per band of ``rows`` registers; the last bits of the times don't count."""
    words = (registers.view(np.uint64) + np.uint64(2048)) >> np.uint64(12)
    grouped = words[:, : bands * rows].reshape(len(words), bands, rows)
    out = np.broadcast_to(np.arange(bands, dtype=np.uint64) * _DRAW, grouped.shape[:2]).copy()
    for k in range(rows):
        out = mix(out ^ grouped[:, :, k]) + _COPY
    return out


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _signed(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, digest, size, bands): shingle count and band hashes, none for texts without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column(2)):
                n = len(offsets) - 1
                owner, element, count = counted(*shingles(data, offsets, width))
                size = np.bincount(owner, count, n).astype(np.int64)
                marks = band_hashes(bag_signatures(owner, element, count, n, bands * rows), bands, rows)
                full = size > 0
                lists = _lists(marks[full].ravel(), np.where(full, bands, 0))
                part = batch.slice(first, n)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(size), lists], ["doc_id", "digest", "size", "bands"])

    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_digest(docs["text"]).alias("digest"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    return slim.mapInArrow(sign, "doc_id long, digest binary, size long, bands array<long>")


def text_digest(text: Column) -> Column:
    """Key of a text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _multisets(texts: DataFrame, width: int) -> DataFrame:
    """(digest, items): the multiset of shingles as a set of (shingle, how-many-eth) hashes."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column(1)):
                n = len(offsets) - 1
                owner, element, count = counted(*shingles(data, offsets, width))
                at = np.repeat(np.arange(len(owner)), count)
                turn = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
                items = mix(element[at] + turn.astype(np.uint64) * _COPY)
                lists = _lists(items, np.bincount(owner[at], minlength=n))
                yield pa.RecordBatch.from_arrays([batch.slice(first, n).column(0), lists], ["digest", "items"])

    return texts.mapInArrow(expand, "digest binary, items array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of digests whose multisets reach the threshold, by exact overlap."""
    left = sets.select(F.col("digest").alias("a"), F.col("items").alias("a_items"))
    right = sets.select(F.col("digest").alias("b"), F.col("items").alias("b_items"))
    common = F.size(F.array_intersect("a_items", "b_items"))
    joined = pairs.join(left, "a").join(right, "b").withColumn("common", common)
    union = F.size("a_items") + F.size("b_items") - F.col("common")
    return joined.where(F.col("common") >= F.lit(threshold) * union).select("a", "b")


def _open_pairs(members: DataFrame, links: DataFrame, roots: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of one bucket but different components that can still reach the threshold.

    Buckets with several components turn to a centre: the text with most links among their members and
    all that share any bucket with these. Members of all buckets of one centre form its family. Each
    is told by how it differs from the items C that most of the family hold: those it misses and those it adds. Two members of n and m
    items have |C| - missed - missed' + d items in common, d of their differences being equal, and
    need t / (1 + t) * (n + m) at threshold t. With g = t / (1 + t) * n + missed - |C| / 2 that is
    d >= g + g'. Pairs with g + g' <= 0 are links, and both are so with the member of least g: a star
    gives their component. Others share that many differences; of each member's the commonest may be left
    out, for whoever shares k of them shares one that is not among the k - 1 commonest. The member of
    smaller g leaves out 2g - 1, as its partner has no smaller g. So edited copies of one text are
    compared only where their edits agree, however many there are. Links to the centre are among the pairs.
    """
    ends = links.select(F.explode(F.array("a", "b")).alias("digest")).groupBy("digest").agg(F.count("*").alias("links"))
    placed = members.select("bucket", "digest", "size").join(roots.withColumnRenamed("id", "digest"), "digest", "left")
    placed = staged(placed.join(ends, "digest", "left").select("bucket", "digest", "size", F.coalesce("root", "digest").alias("root"), F.coalesce("links", F.lit(0)).alias("links")), "placed")
    centre = F.max(F.struct("links", "digest", "root"))
    near = placed.groupBy("bucket").agg(centre.alias("c"))
    seen = staged(placed.join(near, "bucket").groupBy("digest").agg(F.max("c").alias("c")), "centres")
    lead = placed.join(seen, "digest").groupBy("bucket").agg(F.max("c").alias("c"), F.min("root").alias("low"), F.max("root").alias("high"))
    split = lead.where("low <> high").select("bucket", "c")
    family = staged(placed.join(split, "bucket").select(F.col("c.digest").alias("centre"), F.col("c.root").alias("centre_root"), "digest", "size", "root").distinct(), "families")

    held = family.join(sets, "digest")
    usual = held.select("centre", F.explode("items").alias("item")).groupBy("centre", "item").agg(F.count("*").alias("n"))
    usual = usual.join(family.groupBy("centre").agg(F.count("*").alias("members")), "centre").where("2 * n > members")
    cores = usual.groupBy("centre").agg(F.collect_list("item").alias("core"))
    none = F.array().cast("array<long>")
    own = held.join(cores, "centre", "left").withColumn("core", F.coalesce("core", none))
    missed = F.transform(F.array_except("core", "items"), lambda x: F.bitwise_not(x))
    share = threshold / (1 + threshold)
    g = F.lit(share) * F.size("items") + F.size(missed) - F.size("core") / 2 - F.lit(1e-6)
    cut = own.select("centre", "centre_root", "digest", "root", g.alias("g"), F.concat(F.array_except("items", "core"), missed).alias("changes"))
    cut = staged(cut, "cut")
    straight = cut.where("root <> centre_root").select(F.col("centre").alias("p"), F.col("digest").alias("q"))
    least = cut.groupBy("centre").agg(F.min(F.struct("g", "digest", "root")).alias("least"))
    sure = cut.join(least, "centre").where("g + least.g <= 0 and root <> least.root").select(F.col("least.digest").alias("p"), F.col("digest").alias("q"))

    able = cut.join(least.select("centre", F.col("least.g").alias("low")), "centre")
    able = able.withColumn("k", F.greatest(F.lit(1), F.ceil(F.col("g") + F.col("low")))).where(F.col("k") <= F.size("changes"))
    items = able.select("centre", "digest", "root", "g", "k", F.explode("changes").alias("item"))
    often = items.groupBy("centre", "item").agg(F.count("*").alias("n")).where("n > 1")
    ranks = Window.partitionBy("centre", "digest").orderBy(F.desc("n"), "item")
    rare = staged(items.join(often, ["centre", "item"]).withColumn("rank", F.row_number().over(ranks)).where("rank >= k"), "rare")
    # Each side knows the partner's g by its class and leaves out as many changes as their sum asks for.
    size = F.floor(2 * F.log2(F.abs("g") + 1))
    rare = rare.withColumn("class", F.when(F.col("g") < 0, -size - 1).otherwise(size).cast("int"))
    ends = rare.groupBy("centre").agg(F.min("class").alias("first"), F.max("class").alias("last"))
    rare = rare.join(ends, "centre")
    least_of = lambda c: F.when(c < 0, 1 - F.pow(F.lit(2.0), -c / 2)).otherwise(F.pow(F.lit(2.0), c / 2) - 1)
    known = lambda rows: rows.where(F.col("rank") >= F.greatest(F.lit(1), F.ceil(F.col("g") + least_of(F.col("other")) - 1e-6)))
    lower = known(rare.withColumn("other", F.explode(F.sequence("class", "last"))))
    lower = lower.select("centre", "item", F.col("class").alias("low_class"), F.col("other").alias("high_class"), *[F.col(c).alias(f"p_{c}") for c in ("digest", "root", "g")])
    upper = known(rare.withColumn("other", F.explode(F.sequence("first", "class"))))
    upper = upper.select("centre", "item", F.col("other").alias("low_class"), F.col("class").alias("high_class"), "digest", "root", "g")
    later = F.struct("p_g", "p_digest") < F.struct("g", "digest")
    alike = lower.join(upper, ["centre", "item", "low_class", "high_class"]).where((F.col("root") != F.col("p_root")) & later & (F.col("g") + F.col("p_g") > 0))

    found = straight.unionByName(sure).unionByName(alike.select(F.col("p_digest").alias("p"), F.col("digest").alias("q")))
    return found.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()


def near_classes(docs: DataFrame, width: int = 5, threshold: float = 0.8, bands: int = 25, rows: int = 5) -> DataFrame:
    """Classes of near-duplicate documents (doc_id, text): linked at weighted Jaccard >= threshold.

    Returns per row doc_id, digest (of its text), class_id (smallest doc_id of its class) and
    class_digest (that document's text). Texts of fewer than ``width`` words are one shingle; texts
    without words (null: empty) match only equal texts. Equal texts always share a class, and only
    one of them is compared. At 25 bands of 5 registers a pair at 0.8 is missed once in 20,000.

    Texts of a bucket are first compared with its smallest digest. Where that leaves several
    components in a bucket, :func:`_open_pairs` gives the pairs that can still be links: none is
    lost, and a bucket of copies costs its size.
    """
    text_batches(docs.sparkSession)
    signed = staged(_signed(docs, width, bands, rows), "signatures")
    texts = staged(signed.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("size").alias("size"), F.first("bands").alias("bands")), "texts")
    banded = texts.where("size > 0").select("digest", "size", F.explode("bands").alias("bucket"))
    busy = banded.groupBy("bucket").agg(F.count("*").alias("n"), F.min(F.struct("digest", "size")).alias("pivot")).where("n > 1")
    members = staged(banded.join(busy, "bucket").select("bucket", "digest", "size", "pivot"), "buckets")
    alike = lambda x, y: F.least(x, y) >= F.lit(threshold) * F.greatest(x, y)  # noqa: E731  no pair of such sizes can fail
    stars = members.where(F.col("digest") != F.col("pivot.digest")).where(alike(F.col("size"), F.col("pivot.size")))
    tested = staged(stars.select(F.col("pivot.digest").alias("a"), F.col("digest").alias("b")).distinct(), "pairs")

    wanted = members.select("digest").distinct().join(texts.select("digest", "doc_id"), "digest")
    named = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_digest(docs["text"]).alias("digest"), docs["text"])
    same = named["doc_id"].eqNullSafe(wanted["doc_id"]) & (named["digest"] == wanted["digest"])
    found = named.join(wanted, same).select(named["digest"], named["text"]).dropDuplicates(["digest"])
    sets = staged(_multisets(found, width), "multisets")

    links = staged(_verified(tested, sets, threshold), "links")
    roots = components(links)
    more = staged(_verified(_open_pairs(members, links, roots, sets, threshold).join(tested, ["a", "b"], "left_anti"), sets, threshold), "links")
    roots = components(links.unionByName(more))

    rooted = signed.join(roots, signed["digest"] == roots["id"], "left").select("doc_id", "digest", F.coalesce("root", "digest").alias("root"))
    rooted = staged(rooted, "rooted")
    firsts = rooted.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("first"))
    return rooted.join(firsts, "root").select("doc_id", "digest", F.col("first.doc_id").alias("class_id"), F.col("first.digest").alias("class_digest"))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The documents with one row of each class left: that of the smallest doc_id."""
    classes = near_classes(docs, **options).select(F.col("class_id").alias("_id"), F.col("class_digest").alias("_digest")).distinct()
    marked = docs.withColumn("_text", text_digest(docs["text"]))
    same = marked["doc_id"].eqNullSafe(classes["_id"]) & (marked["_text"] == classes["_digest"])
    return marked.join(classes, same).dropDuplicates(["_id", "_digest"]).select(*docs.columns)
