"""The prefix trie of conversations: which first turns conversations share, and how much text that saves.

A node is a distinct sequence of first turns; its name is the smallest conversation that starts with it, and its depth.

1. Prefix sums: every turn gets a 128-bit hash of its place, role and text, and the running sum of these numbers along a
   conversation stands for its prefix. The sums run over range pieces (``operators.scan``), so a conversation of any length
   is spread over tasks. A pre-aggregated count by prefix gives the nodes.
2. Euler-tour technique: every node has an enter and an exit arc. An enter arc goes on to the first child's enter arc, or
   to its own exit; an exit arc to the next sibling's enter arc, or to the parent's exit. Siblings follow each other in the
   order of node numbers; the next one is found by a scan over pieces, so a node may have any number of children.
3. The tour is ranked as a list (``listrank``) with three weights: arcs, leaves, and tokens saved at the node itself. A
   node's subtree lies between its two arcs, so the difference of the sums at both is its number of nodes, leaves and
   tokens saved.
4. ``ends_sha256`` feeds the conversations that end at a node to one hash in the order of their ids. That is a chain by its
   nature: a task streams sorted ids and holds one batch.

Defined results: turns are ordered by ``turn``, null first, then role, then text; rows that agree in all of them follow
each other as separate turns. A null role or text is empty. Rows with a null conv_id belong to no conversation and are left
out. An empty table has no nodes, not even a root. Turns nobody shares save nothing; texts count in code points at any
length. Extra columns are not read. Equal 128-bit sums stand for equal prefixes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import stored
from cartwheel.llm.listrank import ranked
from cartwheel.operators.scan import Scan, keyed_scan

EMPTY_SHA = hashlib.sha256(b"").hexdigest()
#: Turn numbers beyond this are held apart by the order inside one position.
_FAR = 1 << 62
KEY = ["depth", "k1", "k2"]


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place from 0, t1, t2, n): every turn's place in its conversation, the hashes and code points of its text."""
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where("conv_id is not null")
    rows = rows.withColumn("at", F.when(F.col("turn").isNull(), -_FAR).otherwise(F.greatest(F.least("turn", F.lit(_FAR)), F.lit(1 - _FAR))))
    tie = Window.partitionBy("conv_id", "at").orderBy(F.asc_nulls_first("turn"), "role", "text")
    turns = rows.select("conv_id", "at", (F.row_number().over(tie) - 1).cast("long").alias("tie"), F.xxhash64(F.lit(1), "role", "text").alias("t1"),
                        F.xxhash64(F.lit(2), "role", "text").alias("t2"), F.char_length("text").cast("long").alias("n"))
    placed = keyed_scan(stored(turns, "trie-turns"), ["conv_id"], "at", [Scan("before", F.lit(1).cast("long"))])
    return placed.select("conv_id", (F.col("before") + F.col("tie")).alias("place"), "t1", "t2", "n")


def rebuilt(turns: DataFrame, base: Column, keep: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations put together anew: the first ``keep`` turns (at most ``most``) of conversation ``base``, then the own
    turns after the first ``keep``. Both are expressions over conv_id. Returns all conv_ids, and the turns by depth from 1."""
    convs = stored(turns.select("conv_id").distinct().withColumns({"base": base, "h": keep.cast("long")}), "trie-convs")
    head = turns.where(F.col("place") < most).withColumnRenamed("conv_id", "base")
    shared = head.join(convs, "base").where("place < h").select("conv_id", (F.col("place") + 1).alias("depth"), "t1", "t2", "n")
    sizes = head.groupBy("base").agg(F.count("*").alias("size"))
    own = turns.withColumns({"base": base, "h": keep.cast("long")}).where("place >= h").join(sizes, "base", "left")
    depth = F.col("place") - F.col("h") + F.least("h", F.coalesce("size", F.lit(0))) + 1
    return convs.select("conv_id"), shared.unionByName(own.select("conv_id", depth.alias("depth"), "t1", "t2", "n"))


def _halves(value: Column) -> list[Column]:
    return [F.shiftrightunsigned(value, 32), value.bitwiseAND(F.lit(0xFFFFFFFF))]


def _joined(high: str | Column, low: str | Column) -> Column:
    """The low 32 bits of two sums in one number."""
    mask = F.lit(0xFFFFFFFF)
    high, low = (F.col(x) if isinstance(x, str) else x for x in (high, low))
    return F.shiftleft(high.bitwiseAND(mask), 32).bitwiseOR(low.bitwiseAND(mask))


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, k1, k2, p1, p2, n): the prefix that ends with each turn, and the one before it."""
    parts = [*_halves(F.xxhash64(F.lit(3), "depth", "t1", "t2")), *_halves(F.xxhash64(F.lit(4), "t2", "depth", "t1"))]
    rows = stored(turns.select("conv_id", "depth", "n", *(c.alias(f"a{i}") for i, c in enumerate(parts))), "trie-rebuilt")
    sums = keyed_scan(rows, ["conv_id"], "depth", [Scan(f"s{i}", F.col(f"a{i}"), "sum", "upto") for i in range(4)])
    before = [F.col(f"s{i}") - F.col(f"a{i}") for i in range(4)]
    return sums.select("conv_id", "depth", _joined("s0", "s1").alias("k1"), _joined("s2", "s3").alias("k2"),
                       _joined(before[0], before[1]).alias("p1"), _joined(before[2], before[3]).alias("p2"), "n")


def _end_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (depth, k1, k2, conv_id) to one hash a node; a node may go on over any number of batches."""
    now, sha = None, None
    names = [*KEY, "ends_sha256"]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 3 + [pa.string()], strict=True)], names)

    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(c).to_numpy() for c in KEY])
        ids = batch.column("conv_id").to_pylist()
        cuts = np.append(np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0))), len(ids))
        done = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            node, text = tuple(key[:, a].tolist()), ",".join(map(str, ids[a:b])).encode()
            if node == now:
                sha.update(b"," + text)
                continue
            if now is not None:
                done.append((*now, sha.hexdigest()))
            now, sha = node, hashlib.sha256(text)
        if done:
            yield out(done)
    if now is not None:
        yield out([(*now, sha.hexdigest())])


def trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv_id, depth, t1, t2, n), with ``convs`` (conv_id) as members of the root.

    One row per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_nodes and n_leaves (of its
    subtree, itself included), saved_tokens (of its subtree: members beyond the first times code points of the last turn) and
    ends_sha256 (of the ids of the members that end here)."""
    steps = stored(prefixes(turns), "trie-prefixes")
    at = F.col("p1").isNotNull()
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    zero = F.lit(0).cast("long")
    root = root.select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id", "n_convs", F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"), zero.alias("n"))
    inner = steps.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("n").alias("n"))
    nodes = root.unionByName(inner).repartitionByRange("conv_id", "depth").sortWithinPartitions("conv_id", "depth")
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "trie-nodes")

    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    below = nodes.where(at).join(above, ["depth", "p1", "p2"])
    links = stored(below.select("node", "parent", "parent_conv_id"), "trie-links")
    children = links.groupBy(F.col("parent").alias("node")).agg(F.min("node").alias("child"), F.count("*").alias("n_children"))
    siblings = keyed_scan(links, ["parent"], "node", [Scan("sibling", F.col("node"), "min", "after")])
    linked = nodes.select("node", "conv_id", "depth", "k1", "k2", "n_convs", "n").join(siblings, "node", "left").join(children, "node", "left")
    linked = stored(linked, "trie-linked")

    into = F.coalesce(F.col("child") * 2, F.col("node") * 2 + 1)
    onward = F.coalesce(F.col("sibling") * 2, F.col("parent") * 2 + 1, F.lit(-1))
    one, none = F.lit(1).cast("long"), zero
    arc = "id", "next", "arcs", "leaves", "saved"
    enter = zip((F.col("node") * 2, into, one, F.col("child").isNull().cast("long"), (F.col("n_convs") - 1) * F.col("n")), arc, strict=True)
    leave = zip((F.col("node") * 2 + 1, onward, one, none, none), arc, strict=True)
    arcs = linked.select(F.inline(F.array(F.struct(*(c.alias(x) for c, x in enter)), F.struct(*(c.alias(x) for c, x in leave)))))
    tour = ranked(arcs, ["arcs", "leaves", "saved"])
    sign = F.when(F.col("id") % 2 == 0, 1).otherwise(-1)
    spans = tour.groupBy(F.floor(F.col("id") / 2).cast("long").alias("node")).agg(*(F.sum(sign * F.col(x)).alias(x) for x in arc[2:]))

    last = steps.groupBy("conv_id").agg(F.max(F.struct("depth", "k1", "k2")).alias("end"))
    ends = convs.join(last, "conv_id", "left").select(*(F.coalesce(f"end.{k}", zero).alias(k) for k in KEY), "conv_id")
    ends = ends.repartition(*KEY).sortWithinPartitions(*KEY, "conv_id").mapInArrow(_end_hashes, "depth long, k1 long, k2 long, ends_sha256 string")

    out = linked.join(spans, "node").join(ends, KEY, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), F.floor((F.col("arcs") + 1) / 2).cast("long").alias("n_nodes"),
                      F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as they are."""
    turns = numbered_turns(conversations).withColumn("depth", F.col("place") + 1)
    return trie(turns.select("conv_id").distinct(), turns.drop("place"))


#: Turns that a conversation of the query's rule takes over, at most.
HEAD = 5


def mixed_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations rebuilt so that hundreds of them share first turns: conversation c starts with the first
    crc32(c) % 6 turns of c - c % 100."""
    conv = F.col("conv_id").cast("long")
    turns = stored(numbered_turns(conversations.withColumn("conv_id", conv)), "trie-numbered")
    convs, shared = rebuilt(turns, F.col("conv_id") - F.col("conv_id") % 100, F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1), HEAD)
    return trie(convs, shared)
