"""Increase of counters over time, with resets.

A counter only grows until its process restarts; a sample below the one before it is a reset, and what
it shows was counted since. Samples of a series are cut into islands at the resets.

A series may hold any share of all samples, so none is put into one window: samples are windowed per
(series, slice of time), and the first sample of a slice takes its predecessor from the last samples of the
slices, one row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Length of a time slice in seconds.
SLICE_SECONDS = 3600


def with_previous(samples: DataFrame, series: str, ts: str, value: str, tiebreak: str,
                  slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Samples with ``previous``, the value before in (ts, tiebreak) order of the same series (null for
    the first), and ``slice``. Samples without series, time or value are left out."""
    rows = samples.where(F.col(series).isNotNull() & F.col(ts).isNotNull() & F.col(value).isNotNull()) \
        .withColumn("slice", F.floor(F.unix_timestamp(F.col(ts).cast("timestamp")) / F.lit(slice_seconds)))
    order = F.struct(F.col(ts), F.col(tiebreak))
    inside = Window.partitionBy(series, "slice").orderBy(ts, tiebreak)
    lasts = rows.groupBy(series, "slice").agg(F.max_by(F.col(value), order).alias("last"))
    before = lasts.select(series, "slice", F.lag("last").over(Window.partitionBy(series).orderBy("slice")).alias("handed"))
    return rows.withColumn("_lag", F.lag(value).over(inside)) \
        .join(before, [series, "slice"], "inner") \
        .withColumn("previous", F.coalesce("_lag", "handed")).drop("_lag", "handed")


def growth(value: Column, previous: Column) -> Column:
    """What a sample adds: the difference, or after a reset the value itself; nothing for a first sample."""
    return F.when(previous.isNull(), F.lit(0.0)).when(value < previous, value).otherwise(value - previous)


def increase(samples: DataFrame, series: str, ts: str, value: str, tiebreak: str,
             slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Per series and slice of time: ``slice_start`` (text, UTC), samples, resets and increase."""
    seen = with_previous(samples, series, ts, value, tiebreak, slice_seconds)
    reset = F.coalesce(F.col(value) < F.col("previous"), F.lit(False))
    per = seen.groupBy(series, "slice").agg(
        F.count(F.lit(1)).alias("n_samples"), F.count_if(reset).alias("n_resets"),
        F.round(F.sum(growth(F.col(value), F.col("previous"))), 6).alias("increase"))
    start = F.date_format(F.timestamp_seconds(F.col("slice") * slice_seconds), "yyyy-MM-dd HH:mm:ss")
    return per.select(series, start.alias("slice_start"), "n_samples", "n_resets", "increase")


def islands(samples: DataFrame, series: str, ts: str, value: str, tiebreak: str,
            slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Runs between resets, numbered from 0 per series: ``island, first_ts, last_ts, n_samples, last_value``."""
    seen = with_previous(samples, series, ts, value, tiebreak, slice_seconds)
    reset = F.coalesce(F.col(value) < F.col("previous"), F.lit(False)).cast("bigint")
    per = seen.groupBy(series, "slice").agg(F.sum(reset).alias("_resets"))
    along = Window.partitionBy(series).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    base = per.select(series, "slice", F.coalesce(F.sum("_resets").over(along), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(series, "slice").orderBy(ts, tiebreak).rowsBetween(Window.unboundedPreceding, 0)
    numbered = seen.withColumn("_in", F.sum(reset).over(inside)).join(base, [series, "slice"], "inner") \
        .withColumn("island", F.col("_base") + F.col("_in"))
    return numbered.groupBy(series, "island").agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("n_samples"),
        F.max(F.col(value)).alias("last_value"))
