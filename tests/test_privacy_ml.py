"""Noise properties; classifier quality on generated messages; report vs brute force."""

from pyspark.sql import functions as F

from tests.conftest import SF0001
from tidepool.operators import classify, features, privacy, synth


def test_noise_repeatable_and_scaled(spark):
    keys = spark.range(20000).select(F.concat(F.lit("k|"), F.col("id").cast("string")).alias("k"))
    noise = keys.select(privacy.laplace(F.col("k"), epsilon=1.0).alias("n"))
    stats = noise.agg(F.avg(F.abs("n")).alias("mad"), F.avg("n").alias("mean")).first()
    assert abs(stats.mad - 1.0) < 0.05 and abs(stats.mean) < 0.05
    again = keys.repartition(7).select(privacy.laplace(F.col("k")).alias("n"))
    assert sorted(r.n for r in noise.collect()) == sorted(r.n for r in again.collect())
    clamp = spark.range(1).select(privacy.noisy_count(F.lit(0), F.lit("x"), epsilon=0.01).alias("c"))
    assert clamp.first().c >= 0


def test_classifier_beats_majority_on_generated_messages(spark):
    driver = spark.read.parquet(f"{SF0001}/events.parquet").select("event_id")
    msgs = synth.synthesize(driver, "event_id").withColumn(
        "label_code", features.label_code(F.col("label"))).withColumnRenamed("message", "text") \
        .withColumn("split", features.split_column(F.col("idx")))
    model = classify.fit(msgs.filter(F.col("split") == "train"))
    pred = classify.predict(model, msgs)
    acc = {r.split: r.accuracy for r in classify.accuracy(pred).collect()}
    majority = msgs.groupBy("label").count().agg(F.max("count")).first()[0] / msgs.count()
    assert acc["test"] > majority + 0.2


def test_classification_report_matches_brute_force(spark):
    pairs = [("complaint", "complaint"), ("complaint", "praise"), ("praise", "praise"),
             ("inquiry", "inquiry"), ("inquiry", "complaint"), ("praise", "praise"),
             ("inquiry", "inquiry")]
    df = spark.createDataFrame(pairs, "label string, predicted_label string")
    got = {r["class"]: r for r in classify.classification_report(df).collect()}
    for c in ("complaint", "praise", "inquiry"):
        tp = sum(1 for y, p in pairs if y == c and p == c)
        pp = sum(1 for _, p in pairs if p == c)
        sup = sum(1 for y, _ in pairs if y == c)
        prec, rec = (tp / pp if pp else 0.0), (tp / sup if sup else 0.0)
        f1 = 2 * prec * rec / (prec + rec) if prec + rec else 0.0
        assert abs(got[c].precision - prec) < 1e-6 and abs(got[c].recall - rec) < 1e-6
        assert abs(got[c].f1 - f1) < 1e-6 and got[c].support == sup
    assert abs(got["accuracy"].f1 - 5 / 7) < 1e-6


def test_model_save_load_and_csv_roundtrip(spark, workdir):
    import os

    from tidepool.sources import streams
    driver = spark.read.parquet(f"{SF0001}/events.parquet").select("event_id")
    msgs = synth.synthesize(driver, "event_id")
    path = os.path.join(workdir, "msgs_csv")
    streams.write_csv_messages(msgs, path)
    back = streams.read_csv_messages(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(
        map(tuple, msgs.select("user_id", "message", "timestamp", "label").collect()))
    train = back.withColumnRenamed("message", "text").withColumn(
        "label_code", features.label_code(F.col("label")))
    model = classify.fit(train)
    classify.save(model, os.path.join(workdir, "model"))
    again = classify.load(os.path.join(workdir, "model"))
    a = classify.predict(model, train).select("text", "predicted_label", "confidence").collect()
    b = classify.predict(again, train).select("text", "predicted_label", "confidence").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert all(r.predicted_label in ("complaint", "praise", "inquiry") for r in a)


def test_label_choices_follow_input(spark):
    rows = spark.createDataFrame([(0, "praise"), (1, None), (2, "inquiry")], "idx long, label string")
    assert synth.label_choices(rows) == ["praise", "inquiry"]
    assert synth.label_choices(rows.filter("label IS NULL")) == ["complaint", "praise", "inquiry"]
    assert synth.label_choices(None) == ["complaint", "praise", "inquiry"]
