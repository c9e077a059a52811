"""Connected components as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.plans.joins import materialize, scratch_scope


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected graph given as BIGINT pairs: (node, root).

    Contraction: every node adopts its neighbour of least hash (if below its own), the edges are
    rewritten between the adopted nodes, and the rounds end when no edge is left; the adoptions
    are then composed backwards. The hash order is random, so long chains shrink by a constant
    share each round. A hub costs one partial-aggregate row per task, never a collected list.
    Each round is written to the shared folder. Null ends and self-links are ignored; an empty
    edge table gives an empty result.
    """
    h = F.xxhash64
    lo, hi = F.least(a, b), F.greatest(a, b)
    with scratch_scope(edges.sparkSession):
        cur = materialize(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()
                                      & (F.col(a) != F.col(b)))
                          .select(lo.cast("bigint").alias("u"), hi.cast("bigint").alias("v"))
                          .distinct())
        steps = []
        while not cur.isEmpty():
            both = cur.select("u", "v").unionByName(cur.select(F.col("v").alias("u"),
                                                               F.col("u").alias("v")))
            near = both.groupBy("u").agg(F.min_by("v", h("v")).alias("m"))
            step = materialize(near.select(
                F.col("u").alias("node"),
                F.when(h("m") < h("u"), F.col("m")).otherwise(F.col("u")).alias("up")))
            steps.append(step)
            pu = step.select(F.col("node").alias("u"), F.col("up").alias("pu"))
            pv = step.select(F.col("node").alias("v"), F.col("up").alias("pv"))
            moved = cur.join(pu, "u").join(pv, "v").where(F.col("pu") != F.col("pv"))
            cur = materialize(moved.select(F.least("pu", "pv").alias("u"),
                                           F.greatest("pu", "pv").alias("v")).distinct())
        if not steps:
            return edges.sparkSession.createDataFrame([], "node bigint, root bigint")
        roots = steps[-1].select("node", F.col("up").alias("root"))
        for step in reversed(steps[:-1]):
            nxt = roots.select(F.col("node").alias("up"), F.col("root").alias("_r"))
            roots = materialize(step.join(nxt, "up", "left").select(
                "node", F.coalesce("_r", "up").alias("root")))
        result = materialize(roots, keep=True)
    return result
