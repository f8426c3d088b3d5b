"""The trie of conversation prefixes: nodes by prefix hashes, subtree totals by time-forward processing."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import WORD, staged, tasks_for
from feedloom.llm.forward_queue import NODES, TOTALS, forward
from feedloom.operators.blocks import freeze_order, with_row_number

#: Subtrees of at most so many turns are one shard's piece.
PIECE_TURNS = 100_000
#: Levels of one piece above those.
BAND_LEVELS = 1024
#: Messages a task's queue holds in memory.
QUEUE_LIMIT = 200_000
_IDS_IN_CHUNK = 8192


def _turns(conversations: DataFrame) -> DataFrame:
    """Frozen (conv_id, _t, c1, c2, words, _slice): numbered turns as 128-bit contents; no text is exchanged."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    words = F.regexp_count(text, F.lit(WORD)).cast("long")
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.xxhash64(role, text).alias("c1"), F.xxhash64(F.lit(11), role, text).alias("c2"), words.alias("words")
    )
    # Repeated rows are counted, then numbered, so that no run of equal rows is one slice.
    counted = rows.groupBy("conv_id", "turn", "c1", "c2").agg(F.first("words").alias("words"), F.count("*").alias("n"))
    single = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).drop("n")
    return with_row_number(freeze_order(single, ["conv_id"], ["turn", "c1", "c2", "copy"]), ["conv_id"])


def shared_head(conv_id: Column) -> Column:
    """Turns a rebuilt conversation takes from its base: unsigned crc32 of the decimal id, modulo 4."""
    return (F.crc32(conv_id.cast("string")) % 4).cast("int")


def _rebuilt(turns: DataFrame, head: Column, base: Column, most: int) -> DataFrame:
    """(conv_id, depth, c1, c2, words, slice, length): the turns of every rebuilt conversation and its root (depth 0)."""
    lengths = turns.groupBy("conv_id").agg(F.max("_t").alias("own")).withColumns({"head": head, "base": base})
    bases = lengths.select(F.col("conv_id").alias("base"), F.least("own", F.lit(most)).alias("available"))
    facts = lengths.join(bases, "base", "left").withColumn("from_base", F.least("head", F.coalesce("available", F.lit(0))))
    facts = facts.withColumn("length", F.col("from_base") + F.greatest(F.col("own") - F.col("head"), F.lit(0)))
    facts = staged(facts.select("conv_id", "base", "head", "from_base", "length"), "trie-lengths")
    own = turns.join(facts, "conv_id").where("_t > head")
    own = own.select("conv_id", (F.col("_t") - F.col("head") + F.col("from_base")).alias("depth"), "c1", "c2", "words", F.col("_slice").alias("slice"), "length")
    first = turns.where(F.col("_t") <= most).select(F.col("conv_id").alias("base"), "_t", "c1", "c2", "words")
    taken = facts.where("from_base > 0").join(first, "base").where("_t <= from_base")
    taken = taken.select("conv_id", F.col("_t").alias("depth"), "c1", "c2", "words", F.lit(-1).cast("long").alias("slice"), "length")
    zero = F.lit(0).cast("long")
    roots = facts.select("conv_id", zero.alias("depth"), zero.alias("c1"), zero.alias("c2"), zero.alias("words"), F.lit(-1).cast("long").alias("slice"), "length")
    return own.unionByName(taken).unionByName(roots)


def _paths(rebuilt: DataFrame) -> DataFrame:
    """Adds (p1, p2): 128 bits that name the sequence of turns up to here.

    Each turn is hashed with its depth, and a prefix is the exclusive or of its turns, so prefixes of
    a long conversation come from slices side by side and one carried value per slice.
    """
    root = F.col("depth") == 0
    zero = F.lit(0).cast("long")
    terms = rebuilt.withColumns({"t1": F.when(root, zero).otherwise(F.xxhash64("depth", "c1", "c2")), "t2": F.when(root, zero).otherwise(F.xxhash64("c2", "depth", "c1"))})
    inside = Window.partitionBy("conv_id", "slice").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = terms.groupBy("conv_id", "slice").agg(F.bit_xor("t1").alias("s1"), F.bit_xor("t2").alias("s2"))
    carried = carried.select("conv_id", "slice", *[F.coalesce(F.bit_xor(s).over(before), zero).alias(s) for s in ("s1", "s2")])
    local = terms.select("conv_id", "slice", "depth", "words", "length", *[F.bit_xor(t).over(inside).alias(t) for t in ("t1", "t2")])
    joined = local.join(carried, ["conv_id", "slice"])
    return joined.select("conv_id", "depth", "words", "length", F.col("t1").bitwiseXOR(F.col("s1")).alias("p1"), F.col("t2").bitwiseXOR(F.col("s2")).alias("p2"))


def _members(paths: DataFrame) -> DataFrame:
    """Each conversation's nodes (conv_id, depth, rep, n_convs, weight, words, childless, ends).

    ``rep``, the smallest member, and depth name a node; ``weight`` counts the turns from it down.
    """
    below = F.col("length") - F.col("depth") + 1
    whole = [F.min("conv_id").alias("rep"), F.count("*").alias("n_convs"), F.sum(below).alias("weight"), F.max(below).alias("longest")]
    joined = paths.join(paths.groupBy("depth", "p1", "p2").agg(*whole), ["depth", "p1", "p2"])
    return joined.select(
        "conv_id", "depth", "rep", "n_convs", "weight", "words", (F.col("longest") == 1).alias("childless"), (F.col("depth") == F.col("length")).alias("ends")
    )


def _nodes(members: DataFrame, piece_turns: int, band_levels: int) -> DataFrame:
    """One row a node: (level, id), parent, n_convs, own value, and its piece.

    A subtree of at most ``piece_turns`` turns below a larger one is a piece, closed downwards. The
    nodes above, few unless a conversation is very long, are cut every ``band_levels`` levels.
    """
    light = F.col("weight") <= piece_turns
    tops = members.where(light).groupBy("conv_id").agg(F.min("depth").alias("top_level"), F.min_by("rep", "depth").alias("top_id"))
    parents = members.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("rep").alias("parent"))
    nodes = members.where("conv_id = rep").join(parents, ["conv_id", "depth"], "left").join(tops, "conv_id", "left")
    starts = members.where(~light & (F.col("depth") % band_levels == 0)).select("conv_id", F.col("depth").alias("band"), F.col("rep").alias("start"))
    band = F.when(~light, F.col("depth") - F.col("depth") % band_levels)
    nodes = nodes.withColumn("band", band).join(starts, ["conv_id", "band"], "left")
    piece_level, piece = F.when(light, F.col("top_level")).otherwise(F.col("band")), F.when(light, F.col("top_id")).otherwise(F.col("start"))
    return nodes.select(
        F.col("depth").alias("level"),
        F.col("conv_id").alias("id"),
        "parent",
        "n_convs",
        ((F.col("n_convs") - 1) * F.col("words")).alias("own"),
        "childless",
        light.alias("light"),
        piece_level.alias("piece_level"),
        piece.alias("piece"),
        ((F.col("depth") == piece_level) & (F.col("conv_id") == piece)).alias("top"),
    )


def _forwarded(nodes: DataFrame, queue_limit: int) -> DataFrame:
    """Totals of nodes within their pieces; whole pieces share a task, in reverse level order."""
    dealt = nodes.repartition(tasks_for(nodes.sparkSession), "piece_level", "piece").sortWithinPartitions(F.desc("level"), "id")
    return dealt.select(*NODES).mapInArrow(forward(queue_limit), TOTALS)


def _posted(nodes: DataFrame, mail: DataFrame | None) -> DataFrame:
    """Nodes with the summed messages of other pieces, (level, id, n_leaves, value) each."""
    if mail is None:
        return nodes.withColumns({f"sent_{s}": F.lit(0).cast("long") for s in ("children", "leaves", "value")})
    sums = [F.count("*").alias("sent_children"), F.sum("n_leaves").alias("sent_leaves"), F.sum("value").alias("sent_value")]
    filled = [F.coalesce(f"sent_{s}", F.lit(0)).cast("long").alias(f"sent_{s}") for s in ("children", "leaves", "value")]
    return nodes.join(mail.groupBy("level", "id").agg(*sums), ["level", "id"], "left").select(*nodes.columns, *filled)


def _mail(tops: DataFrame, totals: DataFrame) -> DataFrame:
    """What the top nodes of pieces send to their parents."""
    return tops.join(totals, ["level", "id"]).select((F.col("level") - 1).alias("level"), F.col("parent").alias("id"), "n_leaves", "value")


def _totals(nodes: DataFrame, band_levels: int, queue_limit: int) -> DataFrame:
    """(level, id, n_children, n_leaves, value) of every node."""
    tops = nodes.where("top and level > 0").select("level", "id", "parent", "light")
    small = staged(_forwarded(_posted(nodes.where("light"), None), queue_limit), "trie-small")
    large = nodes.where("not light")
    below = staged(_mail(tops.where("light"), small), "trie-mail")
    # Sums of the upper pieces alone, then one pass over piece roots, whose levels are bands.
    alone = _forwarded(_posted(large, below), queue_limit)
    holders = large.select((F.col("level") + 1).alias("level"), F.col("id").alias("parent"), F.col("piece").alias("up"))
    above = tops.where("not light").join(holders, ["level", "parent"]).select("level", "id", "up")
    roots = large.where("top").select("level", "id").join(alone, ["level", "id"]).join(above, ["level", "id"], "left")
    zero = F.lit(0).cast("long")
    pieces = roots.select(
        (F.col("level") / band_levels).cast("long").alias("level"),
        "id",
        F.coalesce("up", zero).alias("parent"),
        F.col("value").alias("own"),
        F.col("n_leaves").alias("sent_leaves"),
        zero.alias("sent_children"),
        zero.alias("sent_value"),
        F.lit(False).alias("childless"),
        (F.col("level") == 0).alias("top"),
        zero.alias("piece_level"),
        zero.alias("piece"),
    )
    whole = _forwarded(pieces, queue_limit).withColumn("level", F.col("level") * band_levels)
    beside = _mail(tops.where("not light"), staged(whole, "trie-roots"))
    return small.unionByName(_forwarded(_posted(large, below.unionByName(beside)), queue_limit))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (level, id, conv_id) to comma-joined ids of one node, some thousand each."""
    names = ["level", "id", "first", "ids"]
    for batch in batches:
        level, node, conv = (batch.column(c).to_numpy() for c in ("level", "id", "conv_id"))
        if not len(level):
            continue
        change = np.flatnonzero((level[1:] != level[:-1]) | (node[1:] != node[:-1])) + 1
        edges = [0, *change.tolist(), len(level)]
        spans = [(a, min(a + _IDS_IN_CHUNK, end)) for begin, end in zip(edges, edges[1:]) for a in range(begin, end, _IDS_IN_CHUNK)]
        starts = [a for a, _ in spans]
        texts = [",".join(map(str, conv[a:b].tolist())) for a, b in spans]
        yield pa.RecordBatch.from_arrays([pa.array(level[starts]), pa.array(node[starts]), pa.array(conv[starts]), pa.array(texts, pa.string())], names)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks to one digest a node; nothing but the running digest is held."""
    now, running, done = None, None, []

    def written() -> pa.RecordBatch:
        columns = zip(*done)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))], ["level", "id", "ends_sha256"])

    for batch in batches:
        for level, node, text in zip(*(batch.column(c).to_pylist() for c in ("level", "id", "ids"))):
            if now != (level, node):
                if now is not None:
                    done.append((*now, running.hexdigest()))
                now, running = (level, node), sha256(text.encode())
            else:
                running.update(b"," + text.encode())
        if done:
            yield written()
            done.clear()
    if now is not None:
        done.append((*now, running.hexdigest()))
        yield written()


def _ends(members: DataFrame) -> DataFrame:
    """(level, id, ends_sha256) of nodes where conversations end; ids are joined in parallel, then digested in order."""
    ends = members.where("ends").select(F.col("depth").alias("level"), F.col("rep").alias("id"), "conv_id")
    laid = ends.repartitionByRange("level", "id", "conv_id").sortWithinPartitions("level", "id", "conv_id")
    chunks = laid.mapInArrow(_chunks, "level long, id long, first long, ids string")
    dealt = chunks.repartition("level", "id").sortWithinPartitions("level", "id", "first")
    return dealt.mapInArrow(_digests, "level long, id long, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame,
    head: Column | None = None,
    base: Column | None = None,
    most: int = 0,
    piece_turns: int = PIECE_TURNS,
    band_levels: int = BAND_LEVELS,
    queue_limit: int = QUEUE_LIMIT,
) -> DataFrame:
    """One row for each distinct sequence of first turns (role, text) of ``conversations`` (conv_id, turn, role, text, …).

    Returns longs conv_id (smallest member) and depth, which name the node, parent_conv_id (null at
    the root), n_convs, n_children, n_leaves, saved_tokens ((n_convs - 1) times the words of the last
    text, summed over the subtree: what sharing prefixes saves) and ends_sha256 (of the ids of the
    conversations that end here, ascending, comma-joined).

    Turns go by ``turn``, null first, ties by a digest of role and text; repeated rows are turns like
    others; a null role or text is empty. With ``head`` and ``base`` (Columns of conv_id) a
    conversation is first rebuilt: the first ``head`` turns of ``base``, at most ``most`` (all it has
    if fewer, none if it is absent), then its own after its first ``head``. Rows without a conv_id
    belong to no conversation. An empty table has no node. Sequences are told apart by 128 bits of
    hash; other columns are ignored.

    Totals come by time-forward processing: nodes stream in reverse level order and send theirs
    ahead to the parent through a queue that spills. Subtrees of at most ``piece_turns`` turns are
    dealt over tasks whole; the tree above them is cut into bands of levels, whose roots make one
    more, smaller tree. No task holds a hot prefix's members: they are counted before.
    """
    none = F.lit(0)
    turns = _turns(conversations)
    rebuilt = _rebuilt(turns, none if head is None else head, F.col("conv_id") if base is None else base, most)
    members = staged(_members(staged(_paths(rebuilt), "trie-paths")), "trie-members")
    nodes = staged(_nodes(members, piece_turns, band_levels), "trie-nodes")
    totals = _totals(nodes, band_levels, queue_limit)
    joined = nodes.select("level", "id", "parent", "n_convs").join(totals, ["level", "id"]).join(_ends(members), ["level", "id"], "left")
    return joined.select(
        F.col("id").alias("conv_id"),
        F.col("level").alias("depth"),
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("value").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"),
    )
