"""Serving tables and the six named views as Spark SQL temp views.

After ``register(spark, processed, outbox, metrics)`` the views can be queried with plain SQL,
e.g. ``spark.sql("SELECT * FROM vw_complaint_spike")``; each view is the DataFrame operator of
``operators/views.py``, so SQL and DataFrame callers get the same plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidepool.operators import views

TABLES = ("processed_messages", "reply_outbox", "metrics")
VIEWS = {
    "vw_label_summary": lambda p, o, m: views.label_summary(p),
    "vw_duplicate_summary": lambda p, o, m: views.duplicate_summary(p),
    "vw_recent_processed": lambda p, o, m: views.recent_processed(p),
    "vw_recent_outbox": lambda p, o, m: views.recent_outbox(o),
    "vw_recent_metrics": lambda p, o, m: views.recent_metrics(m),
    "vw_complaint_spike": lambda p, o, m: views.complaint_spike(p),
}


def register(spark: SparkSession, processed: DataFrame, outbox: DataFrame,
             metrics: DataFrame) -> list[str]:
    for name, df in zip(TABLES, (processed, outbox, metrics)):
        df.createOrReplaceTempView(name)
    p, o, m = (spark.table(t) for t in TABLES)
    for name, build in VIEWS.items():
        build(p, o, m).createOrReplaceTempView(name)
    return list_tables(spark)


def list_tables(spark: SparkSession) -> list[str]:
    """Names of the registered tables and views (the catalog listing after set-up)."""
    return sorted(t.name for t in spark.catalog.listTables())
