"""Complaint rate per sliding event-time window, over a stream (append mode) or a finished table.

A stream's rows pass a watermark: the latest event time of earlier epochs less ``delay``. A row older than
that is late: it is dropped and counted, not merged into a window that was already written. So is a
repeated ``seq`` within the delay (at-least-once sources send rows twice). What is left is counted per
window by partial aggregates in the state store, and a window is written once, when the watermark passes
its end; the file sink keeps each epoch's windows exactly once, also over a restart.

A key never holds more than the windows' partial counts: a third of all rows in one window is one row per task.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

WINDOW, SLIDE, DELAY = "10 minutes", "5 minutes", "10 minutes"
DROP_OPERATOR = "dedupeWithinWatermark"


def complaint_rates(rows: DataFrame, time: str = "created_at", label: str = "predicted_label",
                    size: str = WINDOW, slide: str = SLIDE) -> DataFrame:
    """window_start, window_end, n_messages, n_complaints, complaint_rate; every row counts in each
    window that holds its time (the start inclusive), a row without a time in none."""
    per = rows.groupBy(F.window(F.col(time), size, slide)).agg(
        F.count(F.lit(1)).alias("n_messages"), F.count_if(F.coalesce(F.col(label) == "complaint", F.lit(False)))
        .alias("n_complaints"))
    return per.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                      "n_messages", "n_complaints",
                      F.round(F.col("n_complaints") / F.col("n_messages"), 6).alias("complaint_rate"))


def windowed_stream(rows: DataFrame, time: str = "created_at", label: str = "predicted_label", key: str = "seq",
                    size: str = WINDOW, slide: str = SLIDE, delay: str = DELAY) -> DataFrame:
    """Closed windows of a stream; ``time`` must be a timestamp."""
    timely = rows.select(key, time, label).withWatermark(time, delay).dropDuplicatesWithinWatermark([key])
    return complaint_rates(timely, time, label, size, slide)


class LateRows(StreamingQueryListener):
    """Counts, per epoch of the named query, the rows that the watermark dropped."""

    def __init__(self, query_name: str):
        self.query_name = query_name
        self.by_epoch: dict[int, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name == self.query_name:
            late = sum(op.numRowsDroppedByWatermark for op in p.stateOperators if op.operatorName == DROP_OPERATOR)
            self.by_epoch[p.batchId] = max(late, self.by_epoch.get(p.batchId, 0))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    @property
    def total(self) -> int:
        return sum(self.by_epoch.values())


def start_windows(rows: DataFrame, root: str, trigger: dict | None = None, query_name: str = "complaint-windows",
                  **options):
    """Start the stream into parquet files under ``root``; ``options`` are those of ``windowed_stream``."""
    writer = (windowed_stream(rows, **options).writeStream.format("parquet").outputMode("append")
              .option("path", os.path.join(root, "windows")).queryName(query_name)
              .option("checkpointLocation", os.path.join(root, "_checkpoints", query_name)))
    return writer.trigger(**(trigger or {"processingTime": "30 seconds"})).start()
