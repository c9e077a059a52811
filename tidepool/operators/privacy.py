"""Laplace-noise counts and the private report, keyed so noise is reproducible per cell.

noise(key) = -b * sign(u) * ln(1 - 2|u|), u = H(seed | key) - 1/2 in (-1/2, 1/2), b = 1 / epsilon
noisy(count) = max(0, round_half_even(count + noise))

u comes from a keyed hash instead of a sequential generator, so the value of a cell does not depend
on partitioning or row order. A published seed voids privacy: pass a secret one in real use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool import config
from tidepool.functions import hashing, text
from tidepool.operators import views


def laplace(key: Column, epsilon: float = config.DP_EPSILON, seed: int = config.DP_SEED) -> Column:
    u = hashing.unit_interval(F.concat(F.lit(f"{seed}|"), key)) - F.lit(0.5)
    scale = 1.0 / epsilon
    return F.lit(-scale) * F.signum(u) * F.log(F.lit(1.0) - F.lit(2.0) * F.abs(u))


def noisy_count(count: Column, key: Column, epsilon: float = config.DP_EPSILON,
                seed: int = config.DP_SEED) -> Column:
    noisy = F.coalesce(count, F.lit(0)).cast("double") + laplace(key, epsilon, seed)
    return F.greatest(F.lit(0), F.bround(noisy, 0).cast("bigint"))


def noisy_label_summary(processed: DataFrame, epsilon: float = config.DP_EPSILON,
                        seed: int = config.DP_SEED) -> DataFrame:
    s = views.label_summary(processed)
    key = F.concat(F.lit("label_summary|"), F.coalesce(F.col("predicted_label"), F.lit("unknown")))
    return s.select("predicted_label", noisy_count(F.col("total_count"), key, epsilon, seed)
                    .alias("noisy_count"))


def private_report(processed: DataFrame, epsilon: float = config.DP_EPSILON,
                   seed: int = config.DP_SEED, include_raw: bool = False) -> DataFrame:
    """Long frame (section, item, noisy_value[, raw_value]); raw counts only on request."""
    labels = views.label_summary(processed).select(
        F.lit("label_summary").alias("section"),
        text.capitalize(F.coalesce(F.col("predicted_label"), F.lit("unknown"))).alias("item"),
        F.col("total_count").alias("raw_value"))
    dups = views.duplicate_summary(processed).selectExpr(
        "stack(3, 'exact_duplicates', exact_duplicates, 'near_duplicates', near_duplicates, "
        "'total_rows', total_rows) as (item, raw_value)").select(
        F.lit("duplicate_summary").alias("section"), "item", "raw_value")
    spike = views.complaint_spike(processed).select(
        F.lit("complaint_spike").alias("section"), F.lit("complaint_count_last_20").alias("item"),
        F.col("complaint_count_last_20").alias("raw_value"))
    allrows = labels.unionByName(dups).unionByName(spike)
    key = F.concat_ws("|", F.col("section"), F.col("item"))
    out = allrows.withColumn("noisy_value", noisy_count(F.col("raw_value"), key, epsilon, seed))
    cols = ["section", "item", "noisy_value"] + (["raw_value"] if include_raw else [])
    return out.select(*cols)
