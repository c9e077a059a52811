"""Per-batch counters, metric rollups, event counters, duration histogram and gauges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool import config
from tidepool.plans.joins import sized_lookup

BATCH_METRICS = ("processed_count", "duplicate_count", "near_duplicate_count",
                 "low_confidence_count")

# Fixed value: default histogram bucket bounds (seconds) of the common metrics client library,
# in order: 0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0, +Inf.
HISTOGRAM_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)


def _metric_rows(agg: DataFrame, epoch: str) -> DataFrame:
    stack = "stack(4, " + ", ".join(
        f"'{name}', {pos}, cast({name} as double)" for pos, name in enumerate(BATCH_METRICS)) + \
        ") as (metric_name, pos, metric_value)"
    return (agg.selectExpr(epoch, "batch_created_at", stack)
            .select((F.col(epoch) * F.lit(len(BATCH_METRICS)) + F.col("pos") + F.lit(1))
                    .cast("bigint").alias("id"),
                    "metric_name", "metric_value",
                    F.col(epoch).cast("string").alias("batch_id"),
                    F.col("batch_created_at").alias("created_at")))


def batch_metrics(flagged: DataFrame, epoch: str = "epoch") -> DataFrame:
    """Four counter rows per non-empty batch (an empty batch has no group, so no rows)."""
    agg = flagged.groupBy(epoch).agg(
        F.count(F.lit(1)).alias("processed_count"),
        F.count_if(F.col("is_duplicate")).alias("duplicate_count"),
        F.count_if(F.col("is_near_duplicate")).alias("near_duplicate_count"),
        F.count_if(F.col("confidence") < F.lit(config.LOW_CONFIDENCE)).alias("low_confidence_count"),
        F.max("created_at").alias("batch_created_at"))
    return _metric_rows(agg, epoch)


def epoch_metrics(flagged: DataFrame, epoch: int) -> DataFrame:
    """The four counter rows of one non-empty micro-batch; zeros when every record was rejected."""
    agg = flagged.agg(
        F.count(F.lit(1)).alias("processed_count"),
        F.count_if(F.col("is_duplicate")).alias("duplicate_count"),
        F.count_if(F.col("is_near_duplicate")).alias("near_duplicate_count"),
        F.count_if(F.col("confidence") < F.lit(config.LOW_CONFIDENCE)).alias("low_confidence_count"),
        F.current_timestamp().cast("timestamp_ntz").alias("batch_created_at"),
    ).withColumn("epoch", F.lit(epoch).cast("bigint"))
    return _metric_rows(agg, "epoch")


def metric_rollup(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("metric_name").agg(
        F.count(F.lit(1)).alias("metric_count"),
        F.round(F.avg("metric_value"), 3).alias("avg_value"))


def metric_avg(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("metric_name").agg(F.round(F.avg("metric_value"), 6).alias("avg_value"))


def event_counter(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("events_processed_total"))


def duration_histogram(durations: DataFrame, value: str = "duration") -> DataFrame:
    """Cumulative bucket counts, sum and count in one pass, as long rows (series, le, value)."""
    v = F.col(value)
    aggs = [F.count_if(v <= F.lit(b)).alias(f"le_{i}") for i, b in enumerate(HISTOGRAM_BOUNDS)]
    aggs += [F.count(v).alias("le_inf"), F.sum(v).alias("total"), F.count(v).alias("n")]
    one = durations.agg(*aggs)
    items = [f"'bucket', '{b}', cast(le_{i} as double)" for i, b in enumerate(HISTOGRAM_BOUNDS)]
    items += ["'bucket', '+Inf', cast(le_inf as double)",
              "'sum', '', round(coalesce(total, 0.0), 6)", "'count', '', cast(n as double)"]
    stack = f"stack({len(items)}, " + ", ".join(items) + ") as (series, le, value)"
    return one.selectExpr(stack)


def latest_gauge(sets: DataFrame, name: str, value: str, ts: str, tiebreak: str) -> DataFrame:
    """Last value set wins, per gauge name: the latest time per name (a size-checked lookup), then
    the largest tie-breaker among the events of that time. All buffers are fixed-width, so both
    aggregates hash; the events themselves are neither sorted nor shuffled."""
    last = sized_lookup(sets.groupBy(name).agg(F.max(ts).alias("_last")))
    named = last.select(F.col(name).alias("_name"), "_last")
    hit = sets.join(named, F.col(name).eqNullSafe(F.col("_name")) & F.col(ts).eqNullSafe(F.col("_last")))
    return hit.groupBy(name).agg(F.max_by(F.col(value), F.col(tiebreak)).alias("gauge_value"))
