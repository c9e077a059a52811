"""Dashboard counts from deltas, deletions with their replies, folding, replays."""

import os

from pyspark.sql import functions as F

from tidepool.operators import monitoring, views
from tidepool.streaming import incremental
from tidepool.streaming.job import MessageJob
from tests.test_stream import _batch, constant_predictor


def predictor(df):
    return constant_predictor(df).withColumn("confidence", F.when(F.length("message") > 8, 0.9).otherwise(0.5)) \
        .withColumn("predicted_label", F.when(F.length("message") != 5, F.col("predicted_label")))


def same_views(spark, job):
    """Every view over the cube equals the view over the surviving rows."""
    rows, cube = job.read(spark, "processed"), job.cube(spark)
    for name, view in incremental.VIEWS.items():
        got = sorted(map(str, view(cube).collect()))
        if name == "counters":
            want = monitoring.epoch_metrics(rows, 0).select("metric_name", "metric_value")
        else:
            want = getattr(views, name)(rows)
        assert got == sorted(map(str, want.collect())), name


def state(spark, job):
    t = job.tables(spark)
    return (sorted(r.id for r in t["processed"].collect()), sorted(r.processed_id for r in t["outbox"].collect()),
            sorted(map(str, job.cube(spark).collect())))


def test_counts_deletions_folds_and_replays(spark, workdir):
    out = os.path.join(workdir, "out")
    job = MessageJob(out, predictor, bloom_size=2000)
    texts = [["first text", "second", "first text", "third"], ["hello", "third", "another one"], ["first text", "last one"]]
    for e, batch in enumerate(texts):
        job.process_batch(_batch(spark, *batch), e)
        same_views(spark, job)
    assert job.cube(spark).agg(F.sum("n")).first()[0] == 9
    # an epoch's delta is of its own rows
    added = {r.epoch: r.n for r in job.read(spark, "cube").groupBy("epoch").agg(F.sum("n").alias("n")).collect()}
    assert added == {0: 4, 1: 3, 2: 2}

    ids = spark.createDataFrame([(1,), (5,), (5,), (8,), (777,)], "id long")
    job.delete(spark, ids, "gdpr-1")
    left = state(spark, job)
    assert left[0] == left[1] == [0, 2, 3, 4, 6, 7]
    same_views(spark, job)
    job.delete(spark, ids, "gdpr-1")  # the same request again
    job.delete(spark, ids, "gdpr-2")  # another one for what is gone already
    job.process_batch(_batch(spark, *texts[2]), 2)  # a replay of the last epoch
    assert state(spark, job) == left and state(spark, MessageJob(out, predictor, bloom_size=2000)) == left

    assert job.fold_deletes(spark) == [0, 1]
    assert state(spark, job) == left
    assert not os.path.exists(os.path.join(out, "processed", "epoch=0"))
    assert os.path.exists(os.path.join(out, "processed", "epoch=2"))  # may still be replayed
    stored = spark.read.parquet(os.path.join(out, "folded", "processed", "fold=0"))
    assert sorted(r.id for r in stored.collect()) == [0, 2, 3, 4, 6]
    assert job.fold_deletes(spark) == []

    job.process_batch(_batch(spark, "one more", "and more"), 3)
    job.delete(spark, spark.createDataFrame([(0,), (9,)], "id long"), "gdpr-3")
    assert job.fold_deletes(spark) == [0, 2]
    again = state(spark, MessageJob(out, predictor, bloom_size=2000))
    assert again[0] == again[1] == [2, 3, 4, 6, 7, 10]
    same_views(spark, job)
    flags = {r.id: r.is_duplicate for r in job.read(spark, "processed").collect()}
    assert flags[2] and flags[7]  # deletion does not forget what was seen


def test_unfinished_request_has_no_effect_until_made_good(spark, workdir):
    out = os.path.join(workdir, "out")
    job = MessageJob(out, predictor, bloom_size=2000)
    job.process_batch(_batch(spark, "first text", "second"), 0)
    before = state(spark, job)
    spark.createDataFrame([(0, 0)], "id long, epoch int").write.parquet(os.path.join(out, "tombstones", "request=x"))
    assert state(spark, job) == before
    job.delete(spark, spark.createDataFrame([(0,)], "id long"), "x")
    assert state(spark, job)[0] == [1]
    same_views(spark, job)


def test_views_of_an_empty_cube(spark, workdir):
    job = MessageJob(os.path.join(workdir, "out"), predictor, bloom_size=2000)
    assert job.cube(spark) is None
    job.process_batch(_batch(spark, "only"), 0)
    job.delete(spark, spark.createDataFrame([(0,)], "id long"), "all")
    same_views(spark, job)
