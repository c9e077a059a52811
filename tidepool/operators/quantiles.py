"""Quantiles of durations: from cumulative buckets, and from mergeable sketches.

Buckets: the quantile's rank falls into a bucket, inside which values are taken as evenly spread
(from 0 below the first bound; beyond the last finite bound the bound itself is given). Exact about the
bucket, it costs one row per bound however many durations there were.

Sketches (KLL): one per epoch or task of a fixed size, merged without rereading rows. ``k`` bounds the error of
a rank: at the default 400 about half a percent of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUANTILES = (0.5, 0.9, 0.95, 0.99)
SKETCH_K = 400


def bucket_quantiles(histogram: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """(quantile, value) from the rows of ``monitoring.duration_histogram`` (series, le, value); null
    where there were no durations."""
    upper = F.when(F.col("le") == "+Inf", F.lit(float("inf"))).otherwise(F.col("le").cast("double"))
    buckets = histogram.where("series = 'bucket'").select(upper.alias("upper"), F.col("value").alias("upto"))
    along = Window.orderBy("upper")  # one row per bound
    buckets = buckets.select(
        "upper", "upto", F.coalesce(F.lag("upper").over(along), F.lit(0.0)).alias("lower"),
        F.coalesce(F.lag("upto").over(along), F.lit(0.0)).alias("below"),
        F.max("upto").over(Window.partitionBy()).alias("total"))
    wanted = F.explode(F.array(*[F.lit(float(q)) for q in quantiles])).alias("quantile")
    ranked = buckets.select("*", wanted).withColumn("rank", F.col("quantile") * F.col("total"))
    hit = ranked.where((F.col("upto") >= F.col("rank")) & (F.col("upto") > 0))
    first = hit.groupBy("quantile").agg(F.min(F.struct("upper", "lower", "below", "upto", "rank")).alias("b"))
    inside = F.col("b.lower") + (F.col("b.upper") - F.col("b.lower")) * (
        F.greatest(F.col("b.rank") - F.col("b.below"), F.lit(0.0)) / (F.col("b.upto") - F.col("b.below")))
    value = F.when(F.col("b.upper") == float("inf"), F.col("b.lower")) \
        .when(F.col("b.upto") == F.col("b.below"), F.col("b.lower")).otherwise(inside)
    every = buckets.select(wanted).distinct()
    return every.join(first, "quantile", "left").select("quantile", F.round(value, 6).alias("value"))


def sketch(value: Column, k: int = SKETCH_K) -> Column:
    """Aggregate: KLL sketch (binary) of the values; nulls are left out."""
    return F.kll_sketch_agg_double(value.cast("double"), F.lit(k))


def epoch_sketches(rows: DataFrame, value: str, by: str = "epoch", k: int = SKETCH_K) -> DataFrame:
    """(by, sketch, n): a delta per epoch, of a size that does not depend on its rows."""
    return rows.where(F.col(value).isNotNull()).groupBy(by).agg(sketch(F.col(value), k).alias("sketch"), F.count(value).alias("n"))


def merged_quantiles(sketches: DataFrame, quantiles: Sequence[float] = QUANTILES, k: int = SKETCH_K) -> DataFrame:
    """(quantile, value, n) over all epochs, from their sketches alone."""
    one = sketches.agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"), F.sum("n").cast("bigint").alias("n")) \
        .where("n > 0")
    wanted = F.array(*[F.lit(float(q)) for q in quantiles])
    pairs = F.arrays_zip(wanted.alias("q"), F.kll_sketch_get_quantile_double("sketch", wanted).alias("v"))
    return one.select("n", F.explode(pairs).alias("p")).select(F.col("p.q").alias("quantile"), F.col("p.v").alias("value"), "n")
