"""Complaint spike alert (newest-N window) and the dashboard's all-time alert."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool import config
from tidepool.operators import views


def spike_alert(processed: DataFrame, threshold: int = config.SPIKE_THRESHOLD,
                window: int = config.SPIKE_WINDOW) -> DataFrame:
    spike = views.complaint_spike(processed, window)
    c = F.col(f"complaint_count_last_{window}")
    return spike.select(c, F.when(c >= F.lit(threshold), F.lit("ALERT"))
                        .otherwise(F.lit("OK")).alias("status"))


def complaint_status(processed: DataFrame, threshold: int = config.DASHBOARD_ALERT) -> DataFrame:
    total = views.complaint_total(processed)
    c = F.col("complaint_count")
    return total.select(c, F.when(c >= F.lit(threshold), F.lit("ALERT TRIGGERED"))
                        .otherwise(F.lit("NORMAL")).alias("complaint_status"))
