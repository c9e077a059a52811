"""Dashboard counts kept up by deltas instead of rescans.

Every count the dashboard shows is a sum over one small cube: rows by label, duplicate flag, near
flag and low confidence (at most a few dozen cells). An epoch adds the cube of its own rows; rows that are
deleted or corrected later are retracted by a delta of negative counts. Merging deltas is a sum, so it
may happen in any order and in any grouping, and a view over the merged cube equals the view over
the surviving rows without reading them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool import config
from tidepool.operators import monitoring

CUBE_KEYS = ("predicted_label", "is_duplicate", "is_near_duplicate", "is_low_confidence")


def cube_delta(rows: DataFrame, sign: int = 1, by: tuple[str, ...] = ()) -> DataFrame:
    """Counts by cube cell (and ``by``, e.g. the epoch) of processed rows; ``sign`` -1 retracts them."""
    low = F.coalesce(F.col("confidence") < F.lit(config.LOW_CONFIDENCE), F.lit(False))
    return rows.select(*by, *CUBE_KEYS[:-1], low.alias(CUBE_KEYS[-1])).groupBy(*by, *CUBE_KEYS) \
        .agg((F.count(F.lit(1)) * F.lit(sign)).alias("n"))


def merge(deltas: list[DataFrame]) -> DataFrame:
    """The cube of all deltas; cells that come to nothing vanish."""
    whole = reduce(lambda a, b: a.unionByName(b), [d.select(*CUBE_KEYS, "n") for d in deltas])
    return whole.groupBy(*CUBE_KEYS).agg(F.sum("n").cast("bigint").alias("n")).where("n <> 0")


def _count(condition=None) -> F.Column:
    n = F.col("n") if condition is None else F.when(condition, F.col("n")).otherwise(F.lit(0))
    return F.coalesce(F.sum(n), F.lit(0)).cast("bigint")


def label_summary(cube: DataFrame) -> DataFrame:
    return cube.groupBy("predicted_label").agg(F.sum("n").cast("bigint").alias("total_count")) \
        .orderBy(F.col("total_count").desc())


def duplicate_summary(cube: DataFrame) -> DataFrame:
    """Sums are null over no rows, as in the view over rows."""
    return cube.agg(F.sum(F.when(F.col("is_duplicate"), F.col("n")).otherwise(0)).cast("bigint").alias("exact_duplicates"),
                    F.sum(F.when(F.col("is_near_duplicate"), F.col("n")).otherwise(0)).cast("bigint").alias("near_duplicates"),
                    _count().alias("total_rows"))


def label_distribution(cube: DataFrame) -> DataFrame:
    label = F.initcap(F.coalesce(F.col("predicted_label"), F.lit("unknown")))
    return cube.groupBy(label.alias("label")).agg(F.sum("n").cast("bigint").alias("label_count"))


def duplicate_breakdown(cube: DataFrame) -> DataFrame:
    one = cube.agg(_count(F.col("is_duplicate")).alias("dup"), _count().alias("total"))
    return one.selectExpr("stack(2, 'Duplicate', dup, 'Non-Duplicate', total - dup) as (kind, row_count)")


def complaint_total(cube: DataFrame) -> DataFrame:
    is_complaint = F.lower(F.coalesce(F.col("predicted_label"), F.lit(""))) == "complaint"
    return cube.agg(_count(is_complaint).alias("complaint_count"))


def top_category(cube: DataFrame) -> DataFrame:
    best = F.min_by(F.col("label"), F.struct(-F.col("label_count"), F.col("label")))
    return label_distribution(cube).agg(F.coalesce(best, F.lit("N/A")).alias("top_category"))


def counters(cube: DataFrame) -> DataFrame:
    """The batch counters' totals (metric_name, metric_value)."""
    names = dict(zip(monitoring.BATCH_METRICS, (None, F.col("is_duplicate"), F.col("is_near_duplicate"),
                                                F.col("is_low_confidence"))))
    one = cube.agg(*[_count(c).alias(name) for name, c in names.items()])
    return one.selectExpr(f"stack({len(names)}, " + ", ".join(f"'{n}', double({n})" for n in names)
                          + ") as (metric_name, metric_value)")


VIEWS = {f.__name__: f for f in (label_summary, duplicate_summary, label_distribution, duplicate_breakdown,
                                 complaint_total, top_category, counters)}
