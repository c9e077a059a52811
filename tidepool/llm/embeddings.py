"""Embedding near-dedup by a forest of random-projection trees.

Equal vectors are one class. Vectors of each length have a forest of their own. Each tree splits a bounded sample by random directions at the median
down to a leaf share; every class walks all trees and, close to a split, goes down both sides
(spill overlap). All pairs inside a leaf are compared in double precision; a pair that shares
several leaves counts in the first of them only, so exact link counts come from sums and never
from a list of pairs. A leaf returns a spanning forest of its links; components are their union.
A leaf that a dense cluster keeps large is compared block by block in separate tasks.

Edge cases: vectors that are null, all zero or hold null or non-finite parts link with nothing and
are kept; only vectors of equal length link; null ids keep their rows (component null
where no member has an id); repeated rows link with each other; an empty table gives an empty
result; further columns are not returned.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import components, materialize
from tidepool.llm.simhash import forest as spanning

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_COSINE = 0.9
TREES = 6
#: Half width of the overlap at a split, in projected units of unit vectors.
SPILL = 0.03
#: Classes aimed at per leaf, the most vectors the trees of a length are fitted on, and the fewest per leaf.
LEAF_ROWS = 2048
SAMPLE_ROWS = 20_000
LEAST_SAMPLE = 24
#: A split that sends more than this share of a node both ways is not made.
MOST_SHARED = 0.6
#: Classes of one leaf compared by one task.
BLOCK_ROWS = 4096
STEP = 1024
PAIR_STEP = 1 << 16
SEED = 7


@dataclass
class Tree:
    """Inner nodes: direction, threshold and children; a negative child -k-1 is leaf k."""

    direction: np.ndarray
    threshold: np.ndarray
    left: list[int]
    right: list[int]


def unit(flat: np.ndarray, dim: int) -> np.ndarray:
    x = flat.reshape(-1, dim).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def grow(x: np.ndarray, leaf_rows: float, rng: np.random.Generator, first_leaf: int) -> tuple[Tree, int]:
    """One tree over the sample; returns it with the number of leaves used so far."""
    dims, cuts, left, right, leaves = [], [], [], [], first_leaf
    work = [(np.arange(len(x)), None)]
    root = None
    while work:
        idx, parent = work.pop()
        node = None
        if len(idx) > max(leaf_rows, LEAST_SAMPLE):
            for _ in range(3):
                d = rng.standard_normal(x.shape[1])
                d /= np.linalg.norm(d)
                p = x[idx] @ d
                cut = float(np.median(p))
                if (np.abs(p - cut) <= SPILL).mean() <= MOST_SHARED and p.min() < cut:
                    node = len(dims)
                    dims.append(d)
                    cuts.append(cut)
                    left.append(0)
                    right.append(0)
                    work += [(idx[p <= cut + SPILL], (node, left)), (idx[p >= cut - SPILL], (node, right))]
                    break
        if node is None:
            node = -leaves - 1
            leaves += 1
        if parent is None:
            root = node
        else:
            parent[1][parent[0]] = node
    tree = Tree(np.array(dims).reshape(-1, x.shape[1]), np.array(cuts), left, right)
    if root is not None and root < 0:  # a single leaf: a split that sends everything left
        tree = Tree(np.zeros((1, x.shape[1])), np.array([np.inf]), [root], [root])
    return tree, leaves


def leaves_of(x: np.ndarray, trees: list[Tree]) -> list[list[int]]:
    """Ascending leaf numbers of every vector."""
    out: list[list[int]] = [[] for _ in range(len(x))]
    for tree in trees:
        work = [(0, np.arange(len(x)))]
        while work:
            node, idx = work.pop()
            if not len(idx):
                continue
            if node < 0:
                for i in idx.tolist():
                    out[i].append(-node - 1)
                continue
            p = x[idx] @ tree.direction[node]
            cut = tree.threshold[node]
            work.append((tree.left[node], idx[p <= cut + SPILL]))
            if np.isfinite(cut):
                work.append((tree.right[node], idx[p >= cut - SPILL]))
    return [sorted(v) for v in out]


def _flat(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)


def _assign(batches: Iterator[pa.RecordBatch], forests: dict[int, list[Tree]]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        length = batch.column("vec").value_lengths().to_numpy(zero_copy_only=False)
        for dim in np.unique(length).tolist():
            part = batch.take(pa.array(np.flatnonzero(length == dim)))
            x = unit(_flat(part.column("vec")), dim)
            yield pa.RecordBatch.from_arrays(
                [part.column("cid"), part.column("mult"), pa.array([v.tobytes() for v in x], pa.binary()),
                 pa.array(leaves_of(x, forests[dim]), pa.list_(pa.int32()))], ["cid", "mult", "vec", "leaves"])


def _deal(batches: Iterator[pa.RecordBatch], blocks: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """A row per leaf (and, in a leaf of several blocks, per pair of blocks it takes part in)."""
    for batch in batches:
        cid = batch.column("cid").to_numpy(zero_copy_only=False)
        row, leaf, one, two, side = [], [], [], [], []
        for i, leaves in enumerate(batch.column("leaves").to_pylist()):
            for k in leaves:
                n = blocks.get(k, 1)
                b = int(cid[i] % n)
                for j in range(n):
                    row.append(i)
                    leaf.append(k)
                    one.append(min(b, j))
                    two.append(max(b, j))
                    side.append(0 if b <= j else 1)
        for at in range(0, len(row), 8192):
            cut = slice(at, at + 8192)
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaf[cut], pa.int32()), pa.array(one[cut], pa.int32()), pa.array(two[cut], pa.int32()),
                 pa.array(side[cut], pa.int32()), *[batch.column(c).take(pa.array(row[cut], pa.int64()))
                                                    for c in ("cid", "mult", "vec", "leaves")]],
                ["leaf", "one", "two", "side", "cid", "mult", "vec", "leaves"])


def first_shared(leaf: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs with ascending leaf lists a, b (padded with -1 and -2) share none before
    ``leaf``. Most pairs of a dense cluster drop out at the first leaf they have in common."""
    left = np.arange(len(a))
    for k in range(a.shape[1]):
        own = a[left, k]
        if not len(left) or not ((own >= 0) & (own < leaf)).any():
            break
        left = left[~((own < leaf) & (b[left] == own[:, None]).any(axis=1))]
    return left


def _compare(part: pd.DataFrame, min_cosine: float) -> pd.DataFrame:
    """Link counts of a leaf's classes (pairs first met here) and a spanning forest of its links."""
    part = part.sort_values(["side", "cid"], ignore_index=True)
    x = np.frombuffer(b"".join(part["vec"]), dtype=np.float64).reshape(len(part), -1)
    mult, cid = part["mult"].to_numpy(), part["cid"].to_numpy()
    leaf = int(part["leaf"].iloc[0])
    split = int((part["side"] == 0).sum())
    same = int(part["one"].iloc[0]) == int(part["two"].iloc[0])
    width = max(map(len, part["leaves"]))
    pad = np.full((len(part), width), -1, dtype=np.int64)
    for i, v in enumerate(part["leaves"]):
        pad[i, :len(v)] = v
    other = np.where(pad < 0, -2, pad)
    links, label = np.zeros(len(part), dtype=np.int64), np.arange(len(part))
    rows = len(part) if same else split
    for i in range(0, rows, STEP):
        for j in range(i if same else split, len(part), STEP):
            hit = x[i:min(i + STEP, rows)] @ x[j:j + STEP].T >= min_cosine
            a, b = np.nonzero(hit)
            a, b = a + i, b + j
            if same:
                a, b = a[a < b], b[a < b]
            for at in range(0, len(a), PAIR_STEP):
                p, q = a[at:at + PAIR_STEP], b[at:at + PAIR_STEP]
                new = first_shared(leaf, pad[p], other[q])
                p, q = p[new], q[new]  # the others were counted and joined where they first met
                links += np.bincount(p, mult[q], len(part)).astype(np.int64)
                links += np.bincount(q, mult[p], len(part)).astype(np.int64)
                lp, lq = label[p], label[q]
                if (lp != lq).any():
                    label = spanning(lp, lq, len(part))[label]
    keep = (links > 0) | (label != np.arange(len(part)))
    return pd.DataFrame({"cid": cid[keep], "up": cid[label[keep]], "links": links[keep]})


def near_vectors(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                 min_cosine: float = MIN_COSINE, n_trees: int = TREES,
                 leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept`` (see the module docstring)."""
    spark = table.sparkSession
    raw = table.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("vec"))
    finite = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    usable = F.col("vec").isNotNull() & F.coalesce(finite, F.lit(False)) \
        & F.coalesce(F.exists("vec", lambda v: v != 0), F.lit(False))
    good, rest = raw.where(usable), raw.where(~usable)
    classes = materialize(good.groupBy("vec").agg(F.min("vec_id").alias("least"),
                                                  F.count(F.lit(1)).alias("mult"))
                          .withColumn("cid", F.monotonically_increasing_id()))
    dims = {r["dim"]: r["count"] for r in  # a row per length that occurs
            classes.groupBy(F.size("vec").alias("dim")).count().collect()}
    alone = rest.select("vec_id", F.lit(0).cast("bigint").alias("n_links"),
                        F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if not dims:
        return alone
    forests, leaves = {}, 0  # leaves are numbered on, so no leaf has vectors of two lengths
    for dim, n in sorted(dims.items()):
        x = np.zeros((1, dim))  # vectors that fit one leaf need no sample
        if n > leaf_rows:
            sample = classes.where(F.size("vec") == dim).orderBy(F.xxhash64("vec"), "cid").limit(SAMPLE_ROWS)
            x = unit(np.array([r["vec"] for r in sample.select("vec").collect()], dtype=np.float64), dim)
        rng, forests[dim] = np.random.default_rng(SEED), []
        for _ in range(n_trees if n > leaf_rows else 1):
            tree, leaves = grow(x, leaf_rows * len(x) / n, rng, leaves)
            forests[dim].append(tree)
    placed = materialize(classes.select("cid", "mult", F.col("vec").cast("array<double>").alias("vec"))
                         .mapInArrow(partial(_assign, forests=forests),
                                     "cid bigint, mult bigint, vec binary, leaves array<int>"))
    sizes = placed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count() \
        .where(F.col("count") > BLOCK_ROWS).collect()  # at most one row per leaf
    blocks = {r["leaf"]: -(-r["count"] // BLOCK_ROWS) for r in sizes}
    dealt = placed.mapInArrow(partial(_deal, blocks=blocks),
                              "leaf int, one int, two int, side int, cid bigint, mult bigint, "
                              "vec binary, leaves array<int>")
    found = materialize(dealt.groupBy("leaf", "one", "two").applyInPandas(
        partial(_compare, min_cosine=min_cosine), "cid bigint, up bigint, links bigint"))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("cid").alias("a"), F.col("up").alias("b"))) \
        .withColumnRenamed("node", "cid")
    joined = classes.select("vec", "cid", "least", "mult").join(links, "cid", "left") \
        .join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    verdict = joined.join(least, "root").select(
        "vec", "component_id", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"))
    linked = good.join(verdict, "vec").select(
        "vec_id", "n_links", "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
    return linked.unionByName(alone.select("vec_id", "n_links", "component_id",
                                           F.coalesce(F.col("vec_id").isNotNull(), F.lit(False)).alias("kept")))
