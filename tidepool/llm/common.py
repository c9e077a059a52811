"""Helpers shared by the corpus operators: hash buckets, running totals; components and scratch tables by import.

Everything here is DataFrame code. Scratch tables go to the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.plans.graph import components  # noqa: F401
from tidepool.plans.joins import materialize  # noqa: F401

#: Words are maximal runs of anything but these six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE_RUN = r"[\x20\x09-\x0D]+"

#: Rows aimed at per hash bucket, and the least number of buckets, of a bucketed ranking.
BUCKET_ROWS = 20_000
MIN_BUCKETS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def bucket_count(rows: int) -> int:
    """Number of hash buckets for ``rows`` rows: grows with the input, never below 1024."""
    return max(MIN_BUCKETS, rows // BUCKET_ROWS)


def free_name(df: DataFrame, stem: str) -> str:
    """``stem``, or a variant of it that no column of ``df`` uses (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    name, i = stem, 0
    while name.lower() in taken:
        i += 1
        name = f"{stem}_{i}"
    return name


def packed_row(cols) -> Column:
    """The given columns as one struct ``_row``, so that their names cannot clash with working
    columns (a constant field stands in where there is none)."""
    fields = [F.col(c) for c in cols] or [F.lit(0).alias("_none")]
    return F.struct(*fields).alias("_row")


def running_before(df: DataFrame, keys: list[str], bucket: str, order: list[Column],
                   size: Column, out: str) -> DataFrame:
    """Add ``out``: the sum of ``size`` over the rows of the same ``keys`` that come earlier in
    (bucket, order). ``keys`` and ``bucket`` must not be null.

    A key may hold any share of the rows: rows are windowed per (keys, bucket), and only one
    total per (keys, bucket) is windowed per key.
    """
    before = [Window.unboundedPreceding, -1]
    totals = df.groupBy(*keys, bucket).agg(F.sum(size).alias("_sum"))
    base = totals.withColumn("_base", F.coalesce(F.sum("_sum").over(
        Window.partitionBy(*keys).orderBy(bucket).rowsBetween(*before)), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(*before)
    staged = df.withColumn("_in", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    return (staged.join(base, [*keys, bucket], "inner")
            .withColumn(out, F.col("_base") + F.col("_in")).drop("_base", "_in"))
