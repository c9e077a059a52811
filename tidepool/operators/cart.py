"""Exact classification tree (gini) on sparse TF-IDF weights, grown level by level.

Every boundary between two neighbouring distinct values of a term is a candidate, as in a sequential tree
builder; nothing is binned. Weights are whole millionths (the rounding of ``features.tfidf``), so
a node's values of one term are at most 1,000,001 and one aggregation by (node, term, value) gives class
counts of a fixed bound, however many rows there are; zeros, which no row stores, are what the node's
counts leave over. Prefix sums along the values score every boundary; a node takes the best one.

A split keeps the most of ``sum(left^2) / n_left + sum(right^2) / n_right`` (the least weighted gini);
ties go to the first term in order, then to the least threshold. The threshold is the middle of the two values; rows at
or below it go left (node 2k), the others right (2k + 1). Like the reference's tree a node is split
unless it is pure, at the last depth, or has no two different values. A leaf predicts its most
frequent class (ties: least code) with its share as confidence.

A level's splits (at most 2^depth rows) are collected and broadcast; rows never are.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool import config
from tidepool.operators import features
from tidepool.plans.joins import materialize

#: Weights are stored as whole parts of this.
UNIT = 1_000_000
CLASSES = len(config.LABELS)
NODE_SCHEMA = ("node bigint, term string, threshold double, "
               + ", ".join(f"c{k} bigint" for k in range(CLASSES)))
_MAP = "map<string, bigint>"


@dataclass(frozen=True)
class Tree:
    """Nodes (node, term, threshold, class counts...); leaves have no term. At most 2^(depth + 1)."""
    nodes: tuple[tuple, ...]
    depth: int

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.nodes), NODE_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        self.frame(spark).coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> Tree:
    rows = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    return Tree(tuple(rows), max((r[0].bit_length() - 1 for r in rows), default=0))


def weight_maps(docs: DataFrame, weights: DataFrame, doc: str = "doc_id") -> DataFrame:
    """``docs`` with ``weights`` (doc_id, term, weight): a map of at most the vocabulary's terms."""
    entry = F.struct("term", F.round(F.col("weight") * UNIT).cast("bigint").alias("v"))
    maps = weights.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(entry)).alias("weights"))
    empty = F.expr(f"cast(map() as {_MAP})")
    return docs.join(maps.withColumnRenamed("doc_id", doc), doc, "left") \
        .withColumn("weights", F.coalesce("weights", empty))


def _class_counts(label: str) -> list[Column]:
    return [F.count_if(F.col(label) == k).alias(f"c{k}") for k in range(CLASSES)]


def _counts(prefix: str) -> list[Column]:
    return [F.col(f"{prefix}{k}") for k in range(CLASSES)]


def _kept(counts: list[Column]) -> Column:
    """Sum of squared class counts over their total."""
    as_double = [c.cast("double") for c in counts]
    squares = reduce(lambda a, b: a + b, [c * c for c in as_double])
    return squares / reduce(lambda a, b: a + b, as_double)


def best_splits(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """Best split (node, term, threshold, l0...) of every node of ``totals`` (node, c0...) from the rows
    (node, y, weights) in it; ``l0...`` are the class counts of its left side."""
    each = list(range(CLASSES))
    total = lambda cols: reduce(lambda a, b: a + b, cols)
    cells = rows.join(F.broadcast(totals.select("node")), "node", "left_semi") \
        .select("node", "y", F.explode("weights").alias("term", "v")).where("v > 0") \
        .groupBy("node", "term", "v").agg(*[F.count_if(F.col("y") == k).alias(f"s{k}") for k in each])
    # at most UNIT values of a term in a node; the boundary below each of them is a candidate
    term = Window.partitionBy("node", "term")
    along = term.orderBy("v")
    below = along.rowsBetween(Window.unboundedPreceding, -1)
    edges = cells.select(
        "node", "term", "v", F.coalesce(F.lag("v").over(along), F.lit(0)).alias("previous"),
        *[F.coalesce(F.sum(f"s{k}").over(below), F.lit(0)).alias(f"b{k}") for k in each],
        *[F.sum(f"s{k}").over(term).alias(f"a{k}") for k in each]).join(F.broadcast(totals), "node")
    left = edges.select("node", "term", ((F.col("v") + F.col("previous")) / 2.0).alias("threshold"), *_counts("c"),
                        *[(F.col(f"c{k}") - F.col(f"a{k}") + F.col(f"b{k}")).alias(f"l{k}") for k in each])
    right = [F.col(f"c{k}") - F.col(f"l{k}") for k in each]
    scored = left.where(total(_counts("l")) > 0) \
        .select("node", "term", "threshold", *_counts("l"), (_kept(_counts("l")) + _kept(right)).alias("kept"))
    order = F.struct((-F.col("kept")).alias("lost"), "term", "threshold", *_counts("l"))
    return scored.groupBy("node").agg(F.min(order).alias("b")) \
        .select("node", "b.term", "b.threshold", *[F.col(f"b.l{k}") for k in each])


def _step(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """Rows sent to the child of their node; rows of a node without a split stay."""
    value = F.coalesce(F.try_element_at("weights", F.col("term")), F.lit(0))
    child = F.col("node") * 2 + (value > F.col("threshold")).cast("bigint")
    joined = rows.join(F.broadcast(splits), "node", "left")
    return joined.withColumn("node", F.when(F.col("term").isNull(), F.col("node")).otherwise(child)) \
        .drop("term", "threshold")


def fit(train: DataFrame, label_col: str = "label_code", depth: int = config.TREE_DEPTH) -> Tree:
    """Tree on ``train`` (``weights`` of ``weight_maps`` and a class code; rows without a code are left out)."""
    spark = train.sparkSession
    rows = materialize(train.where(F.col(label_col).isNotNull())
                       .select(F.lit(1).cast("bigint").alias("node"), F.col(label_col).alias("y"), "weights"))
    first = rows.groupBy("node").agg(*_class_counts("y")).collect()
    nodes, level, here = [], 0, {r.node: tuple(r)[1:] for r in first}
    while here:  # at most 2^level nodes
        mixed = [(n, *counts) for n, counts in here.items() if sum(c > 0 for c in counts) > 1]
        splits = {}
        if mixed and level < depth:
            totals = spark.createDataFrame(mixed, "node bigint, " + ", ".join(f"c{k} bigint" for k in range(CLASSES)))
            splits = {r.node: r for r in best_splits(rows, totals).collect()}
        nodes += [(n, splits[n].term if n in splits else None, splits[n].threshold if n in splits else None, *counts)
                  for n, counts in here.items()]
        below = {}
        for n, s in splits.items():
            below[2 * n] = tuple(s)[3:]
            below[2 * n + 1] = tuple(c - left for c, left in zip(here[n], tuple(s)[3:]))
        here, level = below, level + 1
        if splits:
            rows = _step(rows, spark.createDataFrame([tuple(s)[:3] for s in splits.values()],
                                                     "node bigint, term string, threshold double"))
    return Tree(tuple(sorted(nodes, key=lambda n: n[0])), depth)


def predict(tree: Tree, docs: DataFrame) -> DataFrame:
    """Adds ``predicted_label`` and ``confidence`` to rows with ``weights`` (an empty tree: null)."""
    nodes = materialize(tree.frame(docs.sparkSession).coalesce(1))
    rows = docs.withColumn("node", F.lit(1).cast("bigint"))
    for level in range(tree.depth):
        here = nodes.where(f"term IS NOT NULL AND node >= {2 ** level} AND node < {2 ** (level + 1)}")
        rows = _step(rows, here.select("node", "term", "threshold"))
    counts = F.array(*_counts("c"))
    most = F.array_max(counts)
    leaves = nodes.select("node", (F.array_position(counts, most) - 1).cast("int").alias("code"),
                          (most / reduce(lambda a, b: a + b, _counts("c"))).alias("confidence"))
    return rows.join(F.broadcast(leaves), "node", "left") \
        .withColumn("predicted_label", features.label_name(F.col("code"))).drop("node", "code", "weights")
