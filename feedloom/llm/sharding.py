"""Sharding by histogram sort: equal bytes per shard, equal texts side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import ranked, staged, utf8_bytes

_KEY_BITS = 62


def sort_key(text: Column, doc_id: Column) -> Column:
    """62 bits: 31 of the text's hash, then 31 of the id's, so copies lie together but can be cut."""
    half = lambda c: F.shiftrightunsigned(F.xxhash64(c), 33)
    return F.shiftleft(half(text), 31).bitwiseOR(half(doc_id))


def splitters(rows: DataFrame, n_shards: int, tolerance: float, fanout: int) -> list[tuple[int, float]]:
    """Cuts of ``rows`` (key, size) into ``n_shards`` of near-equal bytes: a key and the share of its
    bytes that lies before the cut.

    Each round counts exact bytes in ``fanout`` cells of every interval that still holds a splitter
    (at most n_shards * fanout sums reach the driver) and goes on in the cell that holds the goal.
    A splitter is done when an edge of its cell is within ``tolerance`` of a shard from the goal, or
    when the cell is a single key, which is then cut where the goal falls into it.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    slack = tolerance * total / n_shards
    goals = [total * k / n_shards for k in range(1, n_shards)]
    open_: dict[int, tuple[int, int, int]] = {k: (0, 1 << _KEY_BITS, 0) for k in range(len(goals))}
    found = [(0, 0.0)] * len(goals)
    while open_ and total:
        cells = sorted({(lo, hi) for lo, hi, _ in open_.values()})
        place = F.lit(None).cast("struct<lo:bigint,cell:bigint>")
        for lo, hi in cells:
            step = -(-(hi - lo) // fanout)
            cell = F.struct(F.lit(lo).cast("bigint").alias("lo"), F.expr(f"(key - {lo}L) div {step}L").alias("cell"))
            place = F.when((F.col("key") >= lo) & (F.col("key") < hi), cell).otherwise(place)
        sums = rows.select(place.alias("p"), "size").where("p is not null").groupBy("p").agg(F.sum("size").alias("n"))
        weight = {(r["p"]["lo"], r["p"]["cell"]): r["n"] for r in sums.collect()}
        for k, (lo, hi, below) in list(open_.items()):
            step, cell = -(-(hi - lo) // fanout), 0
            while below + weight.get((lo, cell), 0) < goals[k] and lo + (cell + 1) * step < hi:
                below += weight.get((lo, cell), 0)
                cell += 1
            left, right = lo + cell * step, min(hi, lo + (cell + 1) * step)
            inside = weight.get((lo, cell), 0)
            before, after = goals[k] - below, below + inside - goals[k]
            if right - left <= 1:
                found[k] = (left, before / inside if inside else 0.0)
            elif min(before, after) <= slack:
                found[k] = (left if before <= after else right, 0.0)
            else:
                open_[k] = (left, right, below)
                continue
            del open_[k]
    return found


def _classed(docs: DataFrame) -> list[Column]:
    """What tells rows apart: equal rows share all of these, and none but doc_id is null."""
    text, doc_id = docs["text"], docs["doc_id"]
    return [
        doc_id,
        F.coalesce(F.concat(F.lit("="), doc_id.cast("string")), F.lit("")).alias("_id"),
        (utf8_bytes(text) + 1).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        sort_key(text, doc_id).alias("key"),
    ]


_CLASS = ["_id", "size", "text_crc32", "key"]


def _pieces(slim: DataFrame, n_shards: int, tolerance: float, fanout: int) -> DataFrame:
    """Classes of equal rows, cut at the shards: shard, ``first`` (copies before the piece), ``n`` and
    ``rank`` (slot of its first copy)."""
    classes = staged(slim.groupBy("doc_id", *_CLASS).agg(F.count("*").alias("copies")), "shards")
    cuts = splitters(classes.select("key", (F.col("size") * F.col("copies")).alias("size")), n_shards, tolerance, fanout)
    key, copies = F.col("key"), F.col("copies")
    before = [F.when(key < at, copies).when(key == at, F.round(copies * F.lit(share)).cast("long")).otherwise(F.lit(0).cast("long")) for at, share in cuts]
    edges = [F.lit(0).cast("long"), *before, copies]
    parts = F.array(*[F.struct(F.lit(i).alias("shard"), low.alias("first"), (high - low).alias("n")) for i, (low, high) in enumerate(zip(edges, edges[1:]))])
    cut = classes.select("doc_id", *_CLASS, F.inline(F.filter(parts, lambda p: p["n"] > 0)))
    return ranked(cut, ["shard"], ["key", "doc_id"], weight="n")


def shard_documents(docs: DataFrame, n_shards: int = 16, tolerance: float = 0.0005, fanout: int = 256) -> DataFrame:
    """Documents (doc_id, text) to shards of near-equal bytes.

    Returns doc_id, size (UTF-8 bytes plus 1; a null text has no bytes), text_crc32 (null: as empty),
    shard and slot (gapless from 0 in the shard). Equal texts share a shard unless a boundary falls
    into their group, so a group of any size is cut where the bytes ask for it. Rows equal in id and
    text are counted before any exchange of rows, cut like the rest, and repeated at the end. An
    empty table gives no rows; other columns are not read.
    """
    pieces = _pieces(docs.select(*_classed(docs)), n_shards, tolerance, fanout)
    each = pieces.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    return each.select("doc_id", "size", "text_crc32", "shard", (F.col("rank") + F.col("copy")).alias("slot"))


def write_shards(docs: DataFrame, path: str, n_shards: int = 16, tolerance: float = 0.0005, fanout: int = 256) -> None:
    """Write exactly the rows of ``docs`` as one folder per shard, each row with its slot.

    Columns named shard or slot give way to the new ones. Rows equal in id and text are numbered by
    a row number that a written table holds fast, so each goes to one slot, whatever their other
    columns hold.
    """
    document = F.struct(*[docs[c] for c in docs.columns if c not in ("shard", "slot")]).alias("document")
    rows = staged(docs.select(document, *_classed(docs), F.monotonically_increasing_id().alias("row")), "rows")
    pieces = _pieces(rows, n_shards, tolerance, fanout)
    held = pieces.groupBy(*_CLASS).agg(F.collect_list(F.struct("shard", "first", "n", F.col("rank").alias("slot"))).alias("pieces"))
    copy = F.col("rank")
    mine = F.filter("pieces", lambda p: (p["first"] <= copy) & (copy < p["first"] + p["n"]))[0]
    placed = ranked(rows, _CLASS, ["row"], held).select("document", copy.alias("copy"), mine.alias("piece"))
    slot = F.col("piece.slot") + F.col("copy") - F.col("piece.first")
    placed.select("document.*", F.col("piece.shard").alias("shard"), slot.alias("slot")).write.partitionBy("shard").parquet(path)
