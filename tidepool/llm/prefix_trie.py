"""Prefix trie of conversations by union-find over sorted-neighbour LCP edges.

Every turn gets the fingerprint of the conversation's prefix up to it: two XORs of 64-bit hashes of
(place, MD5 of the turn), so it is a running aggregate and two prefixes are taken as equal by 128 bits.
A conversation is cut into segments of ``SEGMENT`` turns; a segment's item carries the fingerprint
before it and those of its turns, so an item is bounded and no conversation is ever one row. Items are
range-sorted by (segment, prefix before, fingerprints, id); conversations with a common prefix
are then neighbours, and every trie node is a run of items.

A task joins neighbouring items of its partition by union-find, edges of the longest common prefix first.
A merge at depth d closes both components (their nodes below d are final in this partition) and opens the branching node
of depth d. Nodes that hold the partition's first or last item may go on beyond its boundary: these
(at most two paths of ``SEGMENT`` + 1 nodes) are contracted to one row each, and equal nodes of different
partitions are merged by fingerprint.

Sums over subtrees are sums over members. A conversation owns the nodes of which it is the smallest member: the end
of its path. With ``a`` the words of its path above what it owns, and ``before`` the words above a node,
the words saved in a subtree are ``sum(a) - a(smallest) - (members - 1) * before``, and its leaves
are the members that own a childless node. So a first forest finds who owns what, a second one adds
``a`` and the leaves, and no job walks the trie level by level.

Edge cases: null roles and texts are empty; rows without a conversation id belong to none; a conversation
without turns ends at the root; equal conversations share all their nodes; no conversations give no nodes.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import WORD, materialize
from tidepool.llm.turn_order import (TURN_RANGE, number_rows, running_per_range, sums_before, turn_digest)
from tidepool.plans.joins import sized_lookup

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEGMENT = 64
#: Items aimed at per partition of the sorted items.
PARTITION_ITEMS = 50_000
#: Parents with more children than this are looked up in a table of their own (one row per as many nodes).
MANY_CHILDREN = 100_000
#: Node rows per Arrow batch.
BATCH_NODES = 50_000

NODE_COLUMNS = ["depth", "f1", "f2", "q1", "q2", "low", "n", "sum_a", "low_a", "leaves", "before"]
NODE_SCHEMA = ", ".join(f"{c} bigint" for c in NODE_COLUMNS) + ", open boolean"


# ---------------------------------------------------------------- turns and their prefixes

def order_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                role: str = "role", text: str = "text") -> DataFrame:
    """Narrow turns: ``conv``, ``place`` (from 1), ``digest`` and ``words`` (of the text)."""
    role_col, text_col = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = number_rows(conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("bigint").alias("conv"), F.col(conv_id).cast("string").alias("_key"),
        F.col(turn).cast("bigint").alias("_turn"), turn_digest(role_col, text_col).alias("_md5"),
        F.regexp_count(text_col, F.lit(WORD)).cast("bigint").alias("words")))
    placed = sums_before(rows, F.lit(1).cast("bigint"), "_before")
    return rows.join(placed, "_uid", "inner").select(
        "conv", (F.col("_before") + 1).alias("place"), F.col("_md5").alias("digest"), "words")


def prefixes(turns: DataFrame) -> DataFrame:
    """Turns (``conv, place, digest, words``, places from 1 without gaps) with the fingerprint
    (``f1``, ``f2``) and the words (``cum``) of the prefix that ends with them."""
    hashed = turns.select("conv", "place", "words", F.xxhash64("digest", "place").alias("h1"),
                          F.xxhash64("place", "digest", F.lit("second")).alias("h2"))
    return running_per_range(hashed, ["conv"], "place", TURN_RANGE,
                             {"f1": ("bit_xor", "h1"), "f2": ("bit_xor", "h2"), "cum": ("sum", "words")})


def segment_items(turns: DataFrame, convs: DataFrame, segment: int) -> DataFrame:
    """One item per conversation and segment; every conversation has a segment 0."""
    cut = turns.groupBy("conv", F.floor((F.col("place") - 1) / F.lit(segment)).alias("seg")).agg(
        F.sort_array(F.collect_list(F.struct("place", "f1", "f2", "h1", "h2", "cum", "words"))).alias("_t"))
    first = F.get("_t", F.lit(0))
    cut = cut.select("conv", "seg", first["f1"].bitwiseXOR(first["h1"]).alias("p1"),
                     first["f2"].bitwiseXOR(first["h2"]).alias("p2"),
                     F.transform("_t", lambda t: F.struct(t["f1"].alias("f1"), t["f2"].alias("f2"))).alias("path"),
                     F.transform("_t", lambda t: t["cum"]).alias("cums"),
                     (first["cum"] - first["words"]).alias("before"))
    zero = F.lit(0).cast("bigint")
    bare = convs.where("length = 0").select(
        "conv", *[zero.alias(c) for c in ("seg", "p1", "p2")],
        F.expr("cast(array() as array<struct<f1: bigint, f2: bigint>>)").alias("path"),
        F.expr("cast(array() as array<bigint>)").alias("cums"), zero.alias("before"))
    return cut.unionByName(bare)


# ---------------------------------------------------------------- forests of sorted neighbours

class _Nodes:
    """Node rows of a task, handed on in Arrow batches."""

    def __init__(self):
        self.columns = [[] for _ in range(len(NODE_COLUMNS) + 1)]

    def add(self, *row):
        for column, value in zip(self.columns, row):
            column.append(value)

    def batch(self) -> pa.RecordBatch:
        types = [pa.int64()] * len(NODE_COLUMNS) + [pa.bool_()]
        arrays = [pa.array(c, t) for c, t in zip(self.columns, types)]
        self.__init__()
        return pa.RecordBatch.from_arrays(arrays, [*NODE_COLUMNS, "open"])


def common_prefix(x: list, y: list) -> int:
    """Length of the common prefix of two lists of prefix fingerprints: once they differ they
    differ to the end, so it is found by halving."""
    low, high = 0, min(len(x), len(y))
    while low < high:
        mid = (low + high + 1) // 2
        if x[mid - 1] == y[mid - 1]:
            low = mid
        else:
            high = mid - 1
    return low


def forest_nodes(items: list, segment: int, first_open: bool, last_open: bool, out: _Nodes) -> None:
    """Nodes of neighbouring items (conv, path, cums, before, a, leaf) of one segment and prefix.

    Depths count from the segment's start; the node above it belongs to the segment before (the
    root, to segment 0)."""
    (seg, p1, p2), rows = items
    n, floor = len(rows), 0 if seg == 0 else 1
    up = list(range(n))
    top = [len(r[1]) for r in rows]
    low = [(r[0], r[4]) for r in rows]
    size, sum_a, leaves = [1] * n, [r[4] for r in rows], [r[5] for r in rows]
    reaches = [False] * n
    reaches[0] |= first_open
    reaches[-1] |= last_open

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def close(x, depth):
        """The component's nodes below ``depth``."""
        _, path, cums, before, _, _ = rows[x]
        for d in range(max(depth + 1, floor), top[x] + 1):
            f1, f2 = path[d - 1] if d else (0, 0)
            q1, q2 = path[d - 2] if d > 1 else (p1, p2)
            words = cums[d - 2] if d > 1 else before
            out.add(seg * segment + d, f1, f2, q1, q2, low[x][0], size[x], sum_a[x], low[x][1],
                    leaves[x], words, reaches[x])

    depth = [common_prefix(rows[i][1], rows[i + 1][1]) for i in range(n - 1)]
    for i in sorted(range(n - 1), key=lambda i: -depth[i]):
        if depth[i] < floor:
            break
        x, y = find(i), find(i + 1)
        close(x, depth[i])
        close(y, depth[i])
        if size[x] < size[y]:
            x, y = y, x
        up[y] = x
        top[x] = depth[i]
        low[x] = min(low[x], low[y])
        size[x] += size[y]
        sum_a[x] += sum_a[y]
        leaves[x] += leaves[y]
        reaches[x] |= reaches[y]
    for x in range(n):
        if up[x] == x:
            close(x, floor - 1)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """((seg, p1, p2), item) for every row of a batch."""
    get = lambda name: batch.column(name).to_pylist()
    paths = batch.column("path")
    start = paths.offsets.to_numpy()
    inner = paths.values
    pairs = list(zip(inner.field("f1").to_pylist(), inner.field("f2").to_pylist()))
    for k, row in enumerate(zip(get("conv"), get("cums"), get("before"), get("a"), get("leaf"),
                                get("seg"), get("p1"), get("p2"))):
        conv, cums, before, a, leaf, *group = row
        yield tuple(group), (conv, pairs[start[k]:start[k + 1]], cums, before, a, leaf)


def _partition_forest(batches: Iterator[pa.RecordBatch], segment: int) -> Iterator[pa.RecordBatch]:
    """All nodes of a sorted partition, group by group."""
    out, group, rows, first = _Nodes(), None, [], True
    for batch in batches:
        for key, item in _rows(batch):
            if key != group and rows:
                forest_nodes((group, rows), segment, first, False, out)
                first, rows = False, []
                if len(out.columns[0]) >= BATCH_NODES:
                    yield out.batch()
            group = key
            rows.append(item)
    if rows:
        forest_nodes((group, rows), segment, first, True, out)
    yield out.batch()


def forest(items: DataFrame, segment: int, partitions: int) -> DataFrame:
    """Trie nodes of the items: local forests, their open paths contracted and merged."""
    order = ["seg", "p1", "p2", "path", "conv"]
    local = materialize(items.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
                        .mapInArrow(lambda batches: _partition_forest(batches, segment), NODE_SCHEMA))
    merged = local.where("open").groupBy("depth", "f1", "f2").agg(
        F.first("q1").alias("q1"), F.first("q2").alias("q2"), F.min(F.struct("low", "low_a")).alias("_low"),
        *[F.sum(c).alias(c) for c in ("n", "sum_a", "leaves")], F.first("before").alias("before"))
    merged = merged.withColumn("low", F.col("_low.low")).withColumn("low_a", F.col("_low.low_a"))
    return local.where("NOT open").select(*NODE_COLUMNS).unionByName(merged.select(*NODE_COLUMNS))


# ---------------------------------------------------------------- the trie

def _end_hashes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of the comma-joined ids of each node, streamed over rows sorted by node and id."""
    node, state = None, None

    def done():
        return pd.DataFrame([(*node, state.hexdigest())], columns=["depth", "f1", "f2", "ends_sha256"])
    for frame in frames:
        keys = frame[["depth", "f1", "f2"]].to_numpy()
        ids = frame["conv"].to_numpy()
        if not len(ids):
            continue
        cut = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        found = []
        for a, b in zip([0, *cut], [*cut, len(ids)]):
            key, text = tuple(int(v) for v in keys[a]), ",".join(map(str, ids[a:b].tolist())).encode()
            if key == node:
                state.update(b"," + text)
                continue
            if node is not None:
                found.append((*node, state.hexdigest()))
            node, state = key, hashlib.sha256(text)
        if found:
            yield pd.DataFrame(found, columns=["depth", "f1", "f2", "ends_sha256"])
    if node is not None:
        yield done()


def with_parents(nodes: DataFrame) -> DataFrame:
    """Nodes (with ``n_children``) and ``parent``, the smallest member of the node above. A node of
    very many children is looked up apart from the rest, so no join key holds more than ``MANY_CHILDREN`` rows."""
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("f1").alias("q1"), F.col("f2").alias("q2"),
                         F.col("low").alias("parent"), "n_children").where("n_children > 0")
    key = ["depth", "q1", "q2"]
    hot = sized_lookup(above.where(F.col("n_children") > MANY_CHILDREN).drop("n_children"))
    looked = nodes.join(hot, key, "left")
    rest = looked.where("parent IS NULL").drop("parent") \
        .join(above.where(F.col("n_children") <= MANY_CHILDREN).drop("n_children"), key, "left")
    return looked.where("parent IS NOT NULL").unionByName(rest.select(*looked.columns))


def prefix_trie(turns: DataFrame, conv_ids: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per trie node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` (words, over the subtree, of all but one member of each node)
    and ``ends_sha256`` (of the ids, ascending and comma-joined, that end there).

    ``turns``: ``conv, place, digest, words`` with places from 1 without gaps; ``conv_ids``: ``conv``, each
    conversation once, those without turns included."""
    paths = materialize(prefixes(turns))
    last = paths.groupBy("conv").agg(F.max(F.struct("place", "f1", "f2", "cum")).alias("_end"))
    end = lambda field: F.coalesce(F.col("_end")[field], F.lit(0).cast("bigint"))
    convs = materialize(conv_ids.join(last, "conv", "left").select(
        "conv", end("place").alias("length"), end("f1").alias("f1"), end("f2").alias("f2"), end("cum").alias("total")))
    items = materialize(segment_items(paths, convs, segment))
    partitions = max(8, -(-items.count() // PARTITION_ITEMS))
    zero = F.lit(0).cast("bigint")

    first = materialize(forest(items.withColumn("a", zero).withColumn("leaf", zero), segment, partitions))
    kids = first.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("f1"),
                                            F.col("q2").alias("f2")).agg(F.count(F.lit(1)).alias("n_children"))
    kids = materialize(kids)
    key = ["depth", "f1", "f2"]
    owned = first.join(kids, key, "left").groupBy(F.col("low").alias("conv")).agg(
        F.min_by("before", "depth").alias("a"), F.max(F.col("n_children").isNull().cast("bigint")).alias("leaf"))
    values = convs.join(owned, "conv", "left").select(
        "conv", F.coalesce("a", "total").alias("a"), F.coalesce("leaf", zero).alias("leaf"))

    nodes = forest(items.join(values, "conv", "inner"), segment, partitions)
    nodes = materialize(nodes.join(kids, key, "left").withColumn("n_children", F.coalesce("n_children", zero)))
    ends = convs.select(F.col("length").alias("depth"), "f1", "f2", "conv").repartition(*key) \
        .sortWithinPartitions(*key, "conv") \
        .mapInPandas(_end_hashes, "depth bigint, f1 bigint, f2 bigint, ends_sha256 string")
    return with_parents(nodes).join(ends, key, "left").select(
        F.col("low").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.col("parent")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), "n_children", F.col("leaves").alias("n_leaves"),
        (F.col("sum_a") - F.col("low_a") - (F.col("n") - 1) * F.col("before")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


# ---------------------------------------------------------------- shared openings

def share_openings(turns: DataFrame, family: int = 20, most: int = 3) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt with the opening of their family's head, as branches of one dialogue.

    ``turns`` are those of ``order_turns``. Conversation c opens with the first h turns of conversation
    ``c - c mod family`` and goes on with its own turns after its first h, h = crc32(c) mod (most + 1).
    Returns the rebuilt turns and the conversations (``conv``)."""
    conv = F.col("conv")
    h = F.crc32(conv.cast("string").cast("binary")) % (most + 1)
    heads = turns.where(F.col("place") <= most)
    size = heads.groupBy("conv").agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed("conv", "_head")
    convs = materialize(turns.select("conv").distinct().withColumn("_h", h)
                        .withColumn("_head", conv - F.pmod(conv, F.lit(family))).join(size, "_head", "left")
                        .withColumn("_got", F.least("_h", F.coalesce("_n", F.lit(0)))))
    opening = convs.where("_got > 0").select("conv", "_head", "_got").join(
        heads.withColumnRenamed("conv", "_head"), "_head", "inner").where(F.col("place") <= F.col("_got"))
    # a conversation's turns after its h-th move up where its head has fewer turns; looked up by
    # range of places, so that a long conversation is not one join key
    after = turns.where(F.col("place") > h).withColumn("_range", F.floor(F.col("place") / F.lit(TURN_RANGE)))
    moved = after.select("conv", "_range").distinct().join(
        convs.select("conv", (F.col("_h") - F.col("_got")).alias("_gap")), "conv", "inner")
    own = after.join(moved, ["conv", "_range"], "inner").withColumn("place", F.col("place") - F.col("_gap"))
    names = ["conv", "place", "digest", "words"]
    return opening.select(*names).unionByName(own.select(*names)), convs.select("conv")
