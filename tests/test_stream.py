"""Streaming job: stream over k files == batch over their union; replay is a no-op."""

import os
import time

from pyspark.sql import functions as F

from tests.conftest import SF0001
from tidepool.operators import dedup
from tidepool.sources import streams, tables
from tidepool.streaming.job import MessageJob


def constant_predictor(df):
    # Stand-in classifier for the plumbing tests: label from message length parity.
    lab = F.when(F.length("message") % 2 == 0, F.lit("praise")).otherwise(F.lit("complaint"))
    return df.withColumn("predicted_label", lab).withColumn("confidence", F.lit(0.9))


def _write_files(spark, src_dir, raw, n_files):
    n = raw.count()
    per = (n + n_files - 1) // n_files
    for k in range(n_files):
        part = raw.filter((F.col("seq") >= k * per) & (F.col("seq") < (k + 1) * per)).orderBy("seq")
        rows = [r.value for r in part.select(
            F.to_json(F.struct("user_id", "message")).alias("value")).collect()]
        path = os.path.join(src_dir, f"part-{k:03d}.json")
        with open(path, "w", encoding="utf-8") as fh:
            fh.write("\n".join(rows) + "\n")
        os.utime(path, (time.time() - 1000 + k, time.time() - 1000 + k))


def test_stream_equals_batch_and_replay_is_noop(spark, workdir):
    raw = tables.raw_messages(spark, SF0001).select("seq", "user_id", "message")
    src = os.path.join(workdir, "in")
    os.makedirs(src)
    _write_files(spark, src, raw, 4)
    job = MessageJob(os.path.join(workdir, "out"), constant_predictor, bloom_size=2000,
                     compact_every=2)
    q = job.start(streams.file_stream(spark, src, 1),
                  checkpoint=os.path.join(workdir, "ckpt"), trigger={"availableNow": True})
    q.awaitTermination(600)
    t = job.tables(spark)
    got = {r.id: (r.is_duplicate, r.is_near_duplicate) for r in t["processed"].collect()}
    batch = dedup.flag_messages(raw, size=2000)
    want = {r.seq: (r.is_duplicate, r.is_near_duplicate) for r in batch.collect()}
    assert got == want
    assert t["outbox"].count() == len(want)
    metrics = t["metrics"]
    assert metrics.count() == 4 * 4
    dup = metrics.filter(F.col("metric_name") == "duplicate_count").agg(F.sum("metric_value")).first()[0]
    assert dup == sum(1 for v in want.values() if v[0])

    # Replaying the last epoch with the same input changes nothing.
    before = sorted(tuple(r) for r in t["processed"].select("id", "is_duplicate", "is_near_duplicate").collect())
    last = sorted(os.listdir(src))[-1]
    replay = spark.read.schema("value string").text(os.path.join(src, last))
    job.process_batch(replay, 3)
    after = sorted(tuple(r) for r in job.tables(spark)["processed"]
                   .select("id", "is_duplicate", "is_near_duplicate").collect())
    assert before == after
    assert os.path.exists(os.path.join(workdir, "out", "state", "band_first_snapshot", "upto=1"))
    # Per-epoch lookup tables are removed from the shared folder once the epoch is written.
    from tidepool.session import checkpoint_dir
    tables_dir = os.path.join(checkpoint_dir(spark), "tables")
    before_run = set(os.listdir(tables_dir)) if os.path.exists(tables_dir) else set()
    job.process_batch(replay, 3)
    after_run = set(os.listdir(tables_dir)) if os.path.exists(tables_dir) else set()
    assert after_run <= before_run


def test_empty_batch_writes_nothing(spark, workdir):
    job = MessageJob(os.path.join(workdir, "out"), constant_predictor)
    job.process_batch(spark.createDataFrame([], "value string"), 0)
    assert job.tables(spark)["processed"] is None
    assert not os.path.exists(os.path.join(workdir, "out", "metrics"))


def test_restart_from_checkpoint_continues(spark, workdir):
    """Stop after two files, add two more, restart on the same checkpoint: state and ids carry on."""
    raw = tables.raw_messages(spark, SF0001).select("seq", "user_id", "message")
    staging = os.path.join(workdir, "staging")
    os.makedirs(staging)
    _write_files(spark, staging, raw, 4)
    src = os.path.join(workdir, "in")
    os.makedirs(src)
    names = sorted(os.listdir(staging))
    job = MessageJob(os.path.join(workdir, "out"), constant_predictor, bloom_size=2000)
    ckpt = os.path.join(workdir, "ckpt")
    for batch in (names[:2], names[2:]):
        for name in batch:
            os.link(os.path.join(staging, name), os.path.join(src, name))
        q = job.start(streams.file_stream(spark, src, 1), checkpoint=ckpt,
                      trigger={"availableNow": True})
        q.awaitTermination(600)
    got = {r.id: (r.is_duplicate, r.is_near_duplicate) for r in job.tables(spark)["processed"].collect()}
    want = {r.seq: (r.is_duplicate, r.is_near_duplicate)
            for r in dedup.flag_messages(raw, size=2000).collect()}
    assert got == want


def test_all_rejected_batch_still_counts(spark, workdir):
    """A non-empty batch with only bad records stores nothing but writes four zero counters."""
    job = MessageJob(os.path.join(workdir, "out"), constant_predictor)
    bad = spark.createDataFrame([("bad{",), ('{"message": 5}',)], "value string")
    job.process_batch(bad, 0)
    t = job.tables(spark)
    assert t["processed"].count() == 0
    assert t["quarantine"].count() == 2
    vals = {r.metric_name: r.metric_value for r in t["metrics"].collect()}
    assert vals == {"processed_count": 0.0, "duplicate_count": 0.0,
                    "near_duplicate_count": 0.0, "low_confidence_count": 0.0}


def test_exact_mode_stream_equals_batch(spark, workdir):
    raw = tables.raw_messages(spark, SF0001).select("seq", "user_id", "message")
    src = os.path.join(workdir, "in")
    os.makedirs(src)
    _write_files(spark, src, raw, 3)
    job = MessageJob(os.path.join(workdir, "out"), constant_predictor, exact=True, compact_every=2)
    q = job.start(streams.file_stream(spark, src, 1),
                  checkpoint=os.path.join(workdir, "ckpt"), trigger={"availableNow": True})
    q.awaitTermination(600)
    got = {r.id: r.is_duplicate for r in job.tables(spark)["processed"].collect()}
    want = {r.seq: r.is_exact_duplicate
            for r in dedup.exact_flags(dedup.with_message_keys(raw)).collect()}
    assert got == want and any(want.values())


def test_fresh_checkpoint_on_used_folder_is_refused(spark, workdir):
    import pytest
    job = MessageJob(os.path.join(workdir, "out"), constant_predictor)
    batch = spark.createDataFrame([('{"message": "hello there", "user_id": "u1"}',)], "value string")
    job.process_batch(batch, 0)
    job.process_batch(batch, 1)
    job.process_batch(batch, 1)  # replay of the latest epoch is fine
    with pytest.raises(RuntimeError):
        job.process_batch(batch, 0)
    assert job.tables(spark)["processed"].count() == 2


def _batch(spark, *messages):
    rows = [('{"message": "%s", "user_id": "u"}' % m,) for m in messages]
    return spark.createDataFrame(rows, "value string")


def test_changed_settings_are_refused(spark, workdir):
    """State made under one setting is not read under another; a new folder is."""
    import pytest
    out = os.path.join(workdir, "out")
    MessageJob(out, constant_predictor, bloom_size=2000).process_batch(_batch(spark, "hello"), 0)
    for other in ({"bloom_size": 100000}, {"num_hashes": 2}, {"lsh_rows": 4}, {"exact": True}):
        job = MessageJob(out, constant_predictor, **{"bloom_size": 2000, **other})
        with pytest.raises(RuntimeError, match="settings"):
            job.process_batch(_batch(spark, "hello"), 1)
    job = MessageJob(out, constant_predictor, bloom_size=2000)
    job.process_batch(_batch(spark, "hello"), 1)
    assert [r.is_duplicate for r in job.tables(spark)["processed"].orderBy("id").collect()] == [False, True]


def test_replay_at_compaction_and_removed_epochs(spark, workdir):
    out = os.path.join(workdir, "out")
    job = MessageJob(out, constant_predictor, bloom_size=2000, compact_every=2)
    for e in range(5):
        job.process_batch(_batch(spark, "first text", f"own text {e}"), e)
    want = sorted(tuple(r) for r in job.tables(spark)["processed"].select("id", "is_duplicate").collect())
    for _ in range(2):  # the epoch that compacted, again, by a job that starts anew
        MessageJob(out, constant_predictor, bloom_size=2000, compact_every=2) \
            .process_batch(_batch(spark, "first text", "own text 4"), 4)
    job = MessageJob(out, constant_predictor, bloom_size=2000, compact_every=2)
    assert want == sorted(tuple(r) for r in job.tables(spark)["processed"].select("id", "is_duplicate").collect())
    assert [d for _, d in want] == [False, False] + [True, False] * 4
    for e in range(5, 8):
        job.process_batch(_batch(spark, "first text", f"own text {e}"), e)
    left = sorted(x for x in os.listdir(os.path.join(out, "state", "bloom_bits")) if x.startswith("epoch="))
    snaps = sorted(os.listdir(os.path.join(out, "state", "bloom_bits_snapshot")))
    assert snaps == ["upto=5"] and left == ["epoch=6", "epoch=7"]
    flags = [r.is_duplicate for r in job.tables(spark)["processed"].orderBy("id").collect()]
    assert flags == [False, False] + [True, False] * 7


def test_listing_does_not_grow_with_epochs(spark, workdir, monkeypatch):
    """After the first look a job lists nothing, however many epochs there are."""
    import tidepool.streaming.job as module
    out = os.path.join(workdir, "out")
    for e in range(200):
        os.makedirs(os.path.join(out, "epoch_log", f"epoch={e}"))
    open(os.path.join(out, "epoch_log", "epoch=199", "_SUCCESS"), "w").close()
    job, calls = MessageJob(out, constant_predictor), []
    real = module.path_exists
    monkeypatch.setattr(module, "path_exists", lambda s, p: calls.append(p) or real(s, p))
    assert job.committed(spark) == list(range(200))
    assert len(calls) == 2
    assert job.committed(spark, before=150) == list(range(150)) and len(calls) == 2


def test_epoch_reads_only_the_buckets_of_its_keys(spark, workdir):
    """While the state grows more than tenfold, a batch of the same few keys reads as many files as at first."""
    from pyspark.sql import functions as F
    out = os.path.join(workdir, "out")
    job = MessageJob(out, constant_predictor, exact=True, compact_every=1, bucket_rows=100)
    few = dedup.with_message_keys(spark.createDataFrame([(f"text 0 {i}",) for i in range(3)], "message string"))
    name, files, rows = "state/msg_first", [], []
    for e in range(5):
        n = 300 * 2 ** e
        job.process_batch(spark.range(n).select(F.to_json(F.struct(
            F.format_string(f"text {e} %d", "id").alias("message"), F.lit("u").alias("user_id"))).alias("value")), e)
        if e:
            state = job.read_state(spark, name, before=e, hit=few)
            files.append(len(state.inputFiles()))
            rows.append(job.read_state(spark, name, before=e).count())
            # nothing is lost to pruning: the batch's keys are found in what is read
            assert state.join(few, "msg_id").count() == 3
    assert rows[-1] >= 10 * rows[0] and max(files) <= 3
    assert len(job._manifest(spark, name, job._snapshots(spark, name)[-1])) >= rows[-1] // 100
    again = MessageJob(out, constant_predictor, exact=True, compact_every=1, bucket_rows=100)
    again.process_batch(spark.createDataFrame([('{"message": "text 0 1", "user_id": "u"}',),
                                               ('{"message": "never seen", "user_id": "u"}',)], "value string"), 5)
    flags = again.tables(spark)["processed"].where("epoch = 5").orderBy("id").collect()
    assert [r.is_duplicate for r in flags] == [True, False]


def test_folding_rewrites_only_changed_buckets(spark, workdir):
    """Unchanged buckets stay in the snapshot that wrote them; replaced folders are removed."""
    out = os.path.join(workdir, "out")
    job = MessageJob(out, constant_predictor, exact=True, compact_every=1, bucket_rows=40)
    job.process_batch(_batch(spark, *[f"start {i}" for i in range(300)]), 0)
    for e in range(1, 6):
        job.process_batch(_batch(spark, f"single {e}"), e)
    name = "state/msg_first"
    manifest = job._manifest(spark, name, job._snapshots(spark, name)[-1])
    assert len(manifest) == 8 and len({at for at, _ in manifest.values()}) > 1
    assert sum(n for _, n in manifest.values()) == 304
    state = job.read_state(spark, name, before=6)
    assert state.count() == state.select("msg_id").distinct().count() == 305
    # the snapshot that the last committed epoch used stays for a replay of the one after it
    assert sorted(os.listdir(os.path.join(out, f"{name}_manifest"))) == ["upto=3", "upto=4"]
    held = {(f"upto={at}", f"bucket={b}") for u in (3, 4) for b, (at, n) in job._manifest(spark, name, u).items() if n}
    root = os.path.join(out, f"{name}_snapshot")
    on_disk = {(u, b) for u in os.listdir(root) for b in os.listdir(os.path.join(root, u)) if b.startswith("bucket=")}
    assert held == on_disk
