"""Serving views and dashboard aggregates over the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool import config

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _ts(col: str) -> F.Column:
    return F.date_format(F.col(col), TS_FORMAT).alias(col)


def newest(df: DataFrame, n: int) -> DataFrame:
    # Ties on created_at are broken by id so the result is determined.
    return df.orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(n)


def label_summary(processed: DataFrame) -> DataFrame:
    return (processed.groupBy("predicted_label").agg(F.count(F.lit(1)).alias("total_count"))
            .orderBy(F.col("total_count").desc()))


def duplicate_summary(processed: DataFrame) -> DataFrame:
    """Conditional sums (NULL on an empty table, like SQL SUM) and the row count."""
    return processed.agg(
        F.sum(F.when(F.col("is_duplicate"), 1).otherwise(0)).cast("bigint").alias("exact_duplicates"),
        F.sum(F.when(F.col("is_near_duplicate"), 1).otherwise(0)).cast("bigint").alias("near_duplicates"),
        F.count(F.lit(1)).alias("total_rows"))


def recent_processed(processed: DataFrame, n: int = config.RECENT_ROWS) -> DataFrame:
    cols = ["id", "original_text", "predicted_label", "confidence", "is_duplicate",
            "is_near_duplicate", "reply_text", "created_at"]
    return newest(processed.select(*cols), n).select(*cols[:-1], _ts("created_at"))


def recent_outbox(outbox: DataFrame, n: int = config.RECENT_ROWS) -> DataFrame:
    cols = ["id", "processed_id", "reply_text", "reply_status", "created_at"]
    return newest(outbox.select(*cols), n).select(*cols[:-1], _ts("created_at"))


def recent_metrics(metrics: DataFrame, n: int = config.RECENT_ROWS) -> DataFrame:
    cols = ["id", "metric_name", "metric_value", "batch_id", "created_at"]
    return newest(metrics.select(*cols), n).select(*cols[:-1], _ts("created_at"))


def complaint_spike(processed: DataFrame, n: int = config.SPIKE_WINDOW) -> DataFrame:
    """Complaints among the newest n rows (the column is named after n): the filter stays above
    the top-n."""
    last = newest(processed.select("id", "created_at", "predicted_label"), n)
    return last.agg(F.count_if(F.col("predicted_label") == F.lit("complaint"))
                    .alias(f"complaint_count_last_{n}"))


def recent_status(processed: DataFrame, n: int = config.STATUS_ROWS) -> DataFrame:
    top = processed.select("id", "hashed_user_id", "predicted_label", "is_duplicate") \
        .orderBy(F.col("id").desc()).limit(n)
    return top.select(
        "id", "hashed_user_id", F.col("predicted_label").alias("label"),
        F.when(F.col("is_duplicate"), F.lit("duplicate")).otherwise(F.lit("normal")).alias("status"))


def processed_sample(processed: DataFrame, n: int = config.SAMPLE_ROWS) -> DataFrame:
    top = processed.select("id", "hashed_user_id", "predicted_label", "confidence",
                           "is_duplicate", "is_near_duplicate").orderBy("id").limit(n)
    return top.withColumn("confidence", F.round("confidence", 3))


def complaint_total(processed: DataFrame) -> DataFrame:
    is_c = F.lower(F.coalesce(F.col("predicted_label"), F.lit(""))) == F.lit("complaint")
    return processed.agg(F.count_if(is_c).alias("complaint_count"))


def label_distribution(processed: DataFrame) -> DataFrame:
    lab = F.initcap(F.coalesce(F.col("predicted_label"), F.lit("unknown")))
    return processed.groupBy(lab.alias("label")).agg(F.count(F.lit(1)).alias("label_count"))


def label_zero_fill(processed: DataFrame) -> DataFrame:
    """Label counts, or every known label with 0 when the table is empty."""
    present = label_distribution(processed)
    domain = processed.sparkSession.createDataFrame(
        [(lab.capitalize(),) for lab in ("inquiry", "complaint", "praise")], "label string")
    any_rows = processed.select(F.lit(1).alias("_any")).limit(1).agg(F.count(F.lit(1))).scalar()
    empty_fill = domain.where(any_rows == F.lit(0)).withColumn("label_count",
                                                               F.lit(0).cast("bigint"))
    return present.unionByName(empty_fill)


def duplicate_breakdown(processed: DataFrame) -> DataFrame:
    one = processed.agg(F.count_if(F.col("is_duplicate")).alias("dup"),
                        F.count(F.lit(1)).alias("total"))
    return one.selectExpr("stack(2, 'Duplicate', dup, 'Non-Duplicate', total - dup) "
                          "as (kind, row_count)")


def top_category(processed: DataFrame) -> DataFrame:
    """Most frequent title-cased label (ties: alphabetical), 'N/A' for an empty table."""
    dist = label_distribution(processed)
    best = F.min_by(F.col("label"), F.struct(-F.col("label_count"), F.col("label")))
    return dist.agg(F.coalesce(best, F.lit("N/A")).alias("top_category"))


def kpi_counts(processed: DataFrame, outbox: DataFrame, metrics: DataFrame) -> DataFrame:
    tagged = (processed.select(F.lit("p").alias("t"))
              .unionByName(outbox.select(F.lit("r").alias("t")))
              .unionByName(metrics.select(F.lit("m").alias("t"))))
    one = tagged.agg(F.count_if(F.col("t") == "p").alias("processed_messages"),
                     F.count_if(F.col("t") == "r").alias("replies_queued"),
                     F.count_if(F.col("t") == "m").alias("metric_rows"))
    logged = F.when(F.col("metric_rows") > 0, F.col("metric_rows")) \
        .otherwise(F.col("processed_messages") + F.col("replies_queued"))
    return one.select("processed_messages", "replies_queued", logged.alias("metrics_logged"))


def outbox_orphans(outbox: DataFrame, surviving: DataFrame) -> DataFrame:
    """Outbox rows whose parent no longer exists (FK violations)."""
    parents = surviving.select(F.col("id").alias("processed_id"))
    return outbox.join(parents, "processed_id", "left_anti").select("id", "processed_id")


def outbox_cascade(outbox: DataFrame, surviving: DataFrame) -> DataFrame:
    """Outbox rows left after ON DELETE CASCADE."""
    parents = surviving.select(F.col("id").alias("processed_id"))
    return outbox.join(parents, "processed_id", "left_semi").select("id", "processed_id",
                                                                    "reply_status")
