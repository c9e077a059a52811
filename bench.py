"""Benchmark the headline queries; prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3)
Each query is executed end to end into the no-op sink (no driver collect); the reported time per
query is the median of the timed runs after one warm-up run.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidepool.plans import catalog  # noqa: E402
from tidepool.session import build_session, scratch_path  # noqa: E402

HEADLINE = [
    "duplicate_summary", "exact_duplicates", "bloom_duplicates", "near_duplicates",
    "label_summary", "recent_processed", "batch_metrics", "decode_messages", "rejected_records",
    "tfidf", "term_stats", "private_report", "synth_messages", "duration_histogram",
    "event_counter",
]


STREAM_EPOCHS = 4


def stream_run(spark, sf_dir: str) -> tuple[float, int]:
    """The documents as JSON wire records, fed to the micro-batch job in STREAM_EPOCHS slices,
    classified by a decision-tree model trained on the labelled documents (fit not timed)."""
    import uuid

    from pyspark.sql import functions as F

    from tidepool.operators import classify, decode, features
    from tidepool.sources import tables
    from tidepool.streaming.job import MessageJob, model_predictor

    run = scratch_path(spark, f"bench-stream-{uuid.uuid4().hex}")
    train = catalog._training_set(spark, sf_dir).withColumn(
        "label_code", features.label_code(F.col("label")))
    classify.save(classify.fit(train), f"{run}/model")
    raw = tables.read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("seq"), F.col("source").alias("user_id"), F.col("text").alias("message"))
    wire = decode.encode(raw, ["user_id", "message"]).select("seq", "value")
    n = raw.count()
    per = -(-n // STREAM_EPOCHS)
    job = MessageJob(f"{run}/out", model_predictor(f"{run}/model"))
    t0 = time.perf_counter()
    for e in range(STREAM_EPOCHS):
        part = wire.filter((F.col("seq") >= e * per) & (F.col("seq") < (e + 1) * per))
        job.process_batch(part.select("value"), e)
    return time.perf_counter() - t0, n


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", app="tidepool-bench", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    times: dict[str, float] = {}
    for name in HEADLINE:
        fn = catalog.QUERIES[name]
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    stream_sec, n_msgs = stream_run(spark, sf_dir)  # one run: it writes tables and state
    times[f"stream_{STREAM_EPOCHS}_epochs"] = round(stream_sec, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else None,
                      "cpus": cpus, "runs": runs,
                      "stream_msgs_per_sec": round(n_msgs / stream_sec, 1)}))
    spark.stop()


if __name__ == "__main__":
    main()
