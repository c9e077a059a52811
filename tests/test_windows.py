"""Event-time windows: a stream's closed windows equal the batch query over its timely rows."""

import os
import random
import time
from datetime import datetime, timedelta

from tidepool.streaming import windows

SCHEMA = "seq bigint, created_at timestamp, predicted_label string"
T0 = datetime(2024, 1, 1)


def brute(rows, size=10, slide=5):
    out = {}
    for _, at, label in rows:
        if at is None:
            continue
        minutes = int((at - T0).total_seconds() // 60)
        for start in range(minutes // slide * slide, minutes - size, -slide):
            n, c = out.get(start, (0, 0))
            out[start] = (n + 1, c + (label == "complaint"))
    return {T0 + timedelta(minutes=s): (n, c, round(c / n, 6)) for s, (n, c) in out.items()}


def as_dict(df):
    rows = df.collect()
    assert all(r.window_end - r.window_start == timedelta(minutes=10) for r in rows)
    out = {r.window_start: (r.n_messages, r.n_complaints, r.complaint_rate) for r in rows}
    assert len(out) == len(rows)
    return out


def make(n, first, rng, seq):
    return [(seq + i, T0 + timedelta(minutes=first, seconds=rng.randrange(1800)),
             rng.choice(["complaint", "praise", None])) for i in range(n)]


def test_batch_windows(spark):
    rng = random.Random(2)
    rows = make(300, 0, rng, 0) + [(999, None, "complaint"), (1000, T0 + timedelta(minutes=10), "complaint"),
                                   (1001, T0 - timedelta(seconds=1), "praise")]
    assert as_dict(windows.complaint_rates(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert windows.complaint_rates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_stream_equals_batch_with_late_and_repeated_rows(spark, workdir):
    rng = random.Random(3)
    src, root = os.path.join(workdir, "in"), os.path.join(workdir, "out")
    os.makedirs(src)
    epochs = [make(80, 0, rng, 0), make(80, 30, rng, 100)]
    # watermark of the third epoch: the latest time so far less ten minutes
    mark = max(r[1] for e in epochs for r in e) - timedelta(minutes=10)
    late = [(200 + i, mark - timedelta(seconds=s), "complaint") for i, s in enumerate([1, 60, 1500])]
    timely = [(300 + i, mark + timedelta(seconds=s), "complaint") for i, s in enumerate([1, 30, 599])]
    repeated = [epochs[1][-1]] if epochs[1][-1][1] > mark else []
    epochs.append(late + timely + repeated + make(50, 60, rng, 400))
    epochs.append([(900, T0 + timedelta(days=2), "praise")])  # moves the watermark past all windows
    kept = epochs[0] + epochs[1] + [r for r in epochs[2] if r not in late and r not in repeated] + epochs[3]

    listener = windows.LateRows("complaint-windows")
    spark.streams.addListener(listener)
    try:
        for k, rows in enumerate(epochs):
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(os.path.join(src, f"part-{k}"))
            time.sleep(0.02)
            if k in (1, 3):  # two files, stop, two more on the same checkpoint
                stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true") \
                    .option("maxFilesPerTrigger", 1).parquet(src)
                q = windows.start_windows(stream, root, trigger={"availableNow": True})
                assert q.awaitTermination(300)
        deadline = time.time() + 30
        while listener.total < len(late) and time.time() < deadline:
            time.sleep(0.2)  # progress events arrive on a thread of their own
    finally:
        spark.streams.removeListener(listener)
    want = brute(kept)
    last = T0 + timedelta(days=2) - timedelta(minutes=10)  # windows past the last watermark stay open
    got = as_dict(spark.read.parquet(os.path.join(root, "windows")))
    assert got == {s: v for s, v in want.items() if s < last}
    assert listener.total == len(late) and any(v == len(late) for v in listener.by_epoch.values())
