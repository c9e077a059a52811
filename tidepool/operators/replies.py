"""Reply routing (template per label above a confidence threshold) and the outbox."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool import config

# Own wording; one template per known label plus the fallback.
TEMPLATES = {
    "complaint": "A colleague has opened a case about this and writes to you within one working day.",
    "praise": "What a lovely note. It is on the wall of our break room now.",
    "inquiry": "Our help pages cover most questions; someone will also answer this one in person.",
}
FALLBACK = "Your message reached us and has been passed to the right desk."


def uses_template(label: Column, confidence: Column,
                  threshold: float = config.REPLY_THRESHOLD) -> Column:
    known = label.isin(*TEMPLATES.keys())
    return F.coalesce((confidence > F.lit(threshold)) & known, F.lit(False))


def reply_text(label: Column, confidence: Column,
               threshold: float = config.REPLY_THRESHOLD) -> Column:
    expr = F.when(~uses_template(label, confidence, threshold), F.lit(FALLBACK))
    for lab, text in TEMPLATES.items():
        expr = expr.when(label == F.lit(lab), F.lit(text))
    return expr.otherwise(F.lit(FALLBACK))


def reply_route(processed: DataFrame, threshold: float = config.REPLY_THRESHOLD) -> DataFrame:
    lab, conf = F.col("predicted_label"), F.col("confidence")
    return processed.select(
        "id", "predicted_label", "confidence",
        F.when(uses_template(lab, conf, threshold), F.lit("template"))
         .otherwise(F.lit("fallback")).alias("route"),
        reply_text(lab, conf, threshold).alias("reply_text"),
        F.coalesce(conf < F.lit(config.LOW_CONFIDENCE), F.lit(False)).alias("is_low_confidence"),
    )


def build_outbox(processed: DataFrame) -> DataFrame:
    """One pending reply per processed row (duplicates included); id follows the parent id."""
    return processed.select(
        F.col("id"), F.col("id").alias("processed_id"), "reply_text",
        F.lit("pending").alias("reply_status"), "created_at",
        F.lit(None).cast("timestamp_ntz").alias("sent_at"))
