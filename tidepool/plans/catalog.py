"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver tables (or frames Spark derives from them) in full.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool import config
from tidepool.functions import hashing
from tidepool.plans.joins import materialize
from tidepool.operators import (alerts, budget, cart, classify as clf, counters, decode, dedup, features, minhash,
                                monitoring, privacy, quantiles, replies, scalable_bloom as growing, synth, views)
from tidepool.session import scratch_path
from tidepool.sources import streams, tables
from tidepool.streaming import incremental, keyed_state, windows

Query = Callable[[SparkSession, str], DataFrame]

TS_FMT = views.TS_FORMAT


def _keyed(spark, sf):
    """Messages with normalised text and id (for queries that return or hash them once)."""
    return dedup.with_message_keys(tables.raw_messages(spark, sf).select("seq", "message"))


def _keys(spark, sf, **parts):
    """Narrow key rows written once, without text (``dedup.key_rows``)."""
    return dedup.key_rows(tables.raw_messages(spark, sf).select("seq", "message"), **parts)


def _processed(spark, sf, *columns):
    return tables.processed(spark, sf, columns)


def _stored(spark, sf, *columns):
    """Columns of the processed table written once, for views that read them several times."""
    return materialize(tables.processed(spark, sf, columns))


FLAG_COLS = tables.FLAGS
METRIC_COLS = ("id", "confidence", *FLAG_COLS, "created_at")
OUTBOX_COLS = ("id", "reply_text", "created_at")


def _newest_rows(spark, sf, order, n, *columns):
    """``columns`` of the first ``n`` rows: the rows are chosen on narrow columns before any text
    is read, any label joined or any flag looked up."""
    ids = order(_processed(spark, sf, "id", "created_at")).limit(n).select("id")
    return tables.processed(spark, sf, columns, only=materialize(ids))


def _newest_first(df):
    return df.orderBy(F.col("created_at").desc(), F.col("id").desc())


def _with_ts(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.date_format(F.col(c), TS_FMT) for c in cols})


# ---------------------------------------------------------------- hashing and dedup

def normalize_text(spark, sf):
    return _keyed(spark, sf).select("seq", "norm")


def hash_users(spark, sf):
    return tables.raw_messages(spark, sf).select(
        "seq", "user_id", hashing.user_hash(F.col("user_id")).alias("hashed_user_id"))


def message_ids(spark, sf):
    return _keyed(spark, sf).select("seq", "msg_id")


def exact_duplicates(spark, sf):
    return dedup.exact_flags(_keys(spark, sf)).select("seq", "msg_id", "is_exact_duplicate")


def bloom_bits(spark, sf):
    cols = [f"b{i}" for i in range(config.BLOOM_HASHES)]
    return dedup.with_bloom_bits(_keyed(spark, sf)).select("seq", *cols)


def bloom_fill(spark, sf):
    return dedup.bloom_fill(dedup.with_bloom_bits(_keyed(spark, sf)))


def bloom_duplicates(spark, sf):
    return dedup.bloom_flags(_keys(spark, sf, size=config.BLOOM_SIZE)).select("seq", "is_duplicate")


def token_buckets(spark, sf):
    v = dedup.with_token_vector(_keyed(spark, sf))
    return v.select("seq", F.array_join(F.col("vector").cast("array<string>"), ",").alias("vector"))


def band_keys(spark, sf):
    return dedup.with_band(_keyed(spark, sf)).select("seq", dedup.band_key_col().alias("band_key"))


def near_duplicates(spark, sf):
    return dedup.near_flags(_keys(spark, sf, rows=config.LSH_ROWS)).select("seq", "msg_id", "is_near_duplicate")


def lsh_candidates(spark, sf):
    c = dedup.lsh_candidates(_keys(spark, sf, rows=config.LSH_ROWS))
    return c.withColumn("candidates", F.array_join("candidates", ","))


#: Design size of the growing filter in its query: a tenth or less of the messages of any test table.
GROWING_CAPACITY = 20


def growing_bloom(spark, sf):
    return growing.flags(tables.raw_messages(spark, sf).select("seq", "message"), capacity=GROWING_CAPACITY)


def minhash_classes(spark, sf):
    return minhash.near_classes(tables.raw_messages(spark, sf).select("seq", "message"))


def keyed_flags(spark, sf):
    """Both flags from a stateful stream over the messages (one trigger takes what is there)."""
    messages = streams.parquet_stream(spark, f"{sf}/documents.parquet").select(
        F.col("doc_id").alias("seq"), F.col("text").alias("message"))
    root = scratch_path(spark, f"streams/{uuid.uuid4().hex}")
    keyed_state.start_keyed_flags(messages, root, trigger={"availableNow": True},
                                  partitions=max(8, spark.sparkContext.defaultParallelism)).awaitTermination()
    return spark.read.schema("seq bigint, msg_id string, is_duplicate boolean, is_near_duplicate boolean") \
        .parquet(f"{root}/flags")


# ---------------------------------------------------------------- views and dashboard

def label_summary(spark, sf):
    return views.label_summary(_processed(spark, sf, "predicted_label"))


def duplicate_summary(spark, sf):
    return views.duplicate_summary(_processed(spark, sf, *FLAG_COLS))


def recent_processed(spark, sf):
    cols = ["id", "original_text", "predicted_label", "confidence", *FLAG_COLS, "reply_text", "created_at"]
    return views.recent_processed(_newest_rows(spark, sf, _newest_first, config.RECENT_ROWS, *cols))


def recent_outbox(spark, sf):
    rows = _newest_rows(spark, sf, _newest_first, config.RECENT_ROWS, *OUTBOX_COLS)
    return views.recent_outbox(tables.outbox(rows))


def recent_metrics(spark, sf):
    return views.recent_metrics(tables.metrics(_processed(spark, sf, *METRIC_COLS)))


def _newest_labels(spark, sf):
    return _newest_rows(spark, sf, _newest_first, config.SPIKE_WINDOW, "id", "created_at", "predicted_label")


def complaint_spike(spark, sf):
    return views.complaint_spike(_newest_labels(spark, sf))


def spike_alert(spark, sf):
    return alerts.spike_alert(_newest_labels(spark, sf))


def complaint_windows(spark, sf):
    """Complaint rate of every ten minutes, each five."""
    return _with_ts(windows.complaint_rates(_processed(spark, sf, "created_at", "predicted_label")),
                    "window_start", "window_end")


def incremental_counts(spark, sf):
    """Label counts and counters from the deltas of the batches, the duplicates retracted afterwards."""
    rows = _stored(spark, sf, *METRIC_COLS, "predicted_label")
    batches = rows.withColumn("epoch", F.expr(f"id div {tables.BATCH_ROWS}"))
    deltas = materialize(incremental.cube_delta(batches, by=("epoch",)))
    cube = materialize(incremental.merge([deltas, incremental.cube_delta(rows.where("is_duplicate"), -1)]))
    labels = incremental.label_distribution(cube).select(
        F.lit("label").alias("section"), F.col("label").alias("item"), F.col("label_count").cast("double").alias("value"))
    totals = incremental.counters(cube).select(
        F.lit("counter").alias("section"), F.col("metric_name").alias("item"), F.col("metric_value").alias("value"))
    return labels.unionByName(totals)


def recent_status(spark, sf):
    return views.recent_status(_newest_rows(
        spark, sf, lambda d: d.orderBy(F.col("id").desc()), config.STATUS_ROWS,
        "id", "hashed_user_id", "predicted_label", "is_duplicate"))


def processed_sample(spark, sf):
    return views.processed_sample(_newest_rows(
        spark, sf, lambda d: d.orderBy("id"), config.SAMPLE_ROWS,
        "id", "hashed_user_id", "predicted_label", "confidence", *FLAG_COLS))


def complaint_total(spark, sf):
    return views.complaint_total(_processed(spark, sf, "predicted_label"))


def complaint_status(spark, sf):
    return alerts.complaint_status(_processed(spark, sf, "predicted_label"))


def label_distribution(spark, sf):
    return views.label_distribution(_processed(spark, sf, "predicted_label"))


def label_zero_fill(spark, sf):
    return views.label_zero_fill(_stored(spark, sf, "predicted_label"))


def duplicate_breakdown(spark, sf):
    return views.duplicate_breakdown(_processed(spark, sf, "is_duplicate"))


def top_category(spark, sf):
    return views.top_category(_processed(spark, sf, "predicted_label"))


def kpi_counts(spark, sf):
    # Only row counts are asked for: one narrow column per table, and the counters' batch keys.
    ids = _processed(spark, sf, "id")
    batches = ids.select(F.expr(f"id div {tables.BATCH_ROWS}").alias("epoch")).distinct()
    counters = batches.select(F.explode(F.sequence(F.lit(1), F.lit(len(monitoring.BATCH_METRICS)))))
    return views.kpi_counts(ids, ids, counters)


def _purged(p: DataFrame) -> DataFrame:
    # Retention rule used for the FK checks: duplicate rows are deleted from processed.
    return p.filter(~F.col("is_duplicate"))


def outbox_orphans(spark, sf):
    p = _stored(spark, sf, *OUTBOX_COLS, "is_duplicate")
    return views.outbox_orphans(tables.outbox(p), _purged(p))


def outbox_cascade(spark, sf):
    p = _stored(spark, sf, *OUTBOX_COLS, "is_duplicate")
    return views.outbox_cascade(tables.outbox(p), _purged(p))


def reply_route(spark, sf):
    return replies.reply_route(_processed(spark, sf, "id", "predicted_label", "confidence"))


def reply_outbox(spark, sf):
    return _with_ts(tables.outbox(_processed(spark, sf, *OUTBOX_COLS)), "created_at", "sent_at")


# ---------------------------------------------------------------- metrics and monitoring

def batch_metrics(spark, sf):
    return _with_ts(tables.metrics(_processed(spark, sf, *METRIC_COLS)), "created_at")


def metric_rollup(spark, sf):
    return monitoring.metric_rollup(tables.metrics(_processed(spark, sf, *METRIC_COLS)))


def metric_avg(spark, sf):
    return monitoring.metric_avg(tables.metrics(_processed(spark, sf, *METRIC_COLS)))


def _events(spark, sf):
    return tables.read_table(spark, sf, "events")


def event_counter(spark, sf):
    return monitoring.event_counter(_events(spark, sf))


def duration_histogram(spark, sf):
    ev = _events(spark, sf).select((F.col("value") / F.lit(100.0)).alias("duration"))
    return monitoring.duration_histogram(ev)


def duration_quantiles(spark, sf):
    return quantiles.bucket_quantiles(duration_histogram(spark, sf))


def counter_increase(spark, sf):
    """Event values read as samples of one counter per event type, by day."""
    return counters.increase(_events(spark, sf), "event_type", "ts", "value", "event_id", slice_seconds=86400)


def counter_islands(spark, sf):
    """Runs without a reset of each user's samples."""
    ev = _events(spark, sf).withColumn("user_id", F.col("user_id").cast("string"))
    return _with_ts(counters.islands(ev, "user_id", "ts", "value", "event_id", slice_seconds=86400), "first_ts", "last_ts")


def latest_gauge(spark, sf):
    ev = _events(spark, sf).withColumnRenamed("event_type", "gauge")
    return monitoring.latest_gauge(ev, "gauge", "value", "ts", "event_id")


# ---------------------------------------------------------------- wire decode and constraints

def publish_json(spark, sf):
    raw = tables.raw_messages(spark, sf)
    return decode.encode(raw, ["user_id", "message"]).select("seq", "value")


def decode_messages(spark, sf):
    return decode.decode(tables.wire_records(spark, sf)).select(
        "origin", "src_id", "part", "user_id", "message")


def rejected_records(spark, sf):
    return decode.rejects(tables.wire_records(spark, sf)).select(
        "origin", "src_id", "part", "reject_reason")


def _broken(df, key, rules):
    """``df`` with each column of ``rules`` (name -> (modulus, bad value)) broken on the rows whose
    key the modulus divides, so that every constraint is violated somewhere."""
    return df.select(*[F.when(F.pmod(F.col(key), F.lit(rules[c][0])) == 0, rules[c][1]).otherwise(F.col(c)).alias(c)
                       if c in rules else F.col(c) for c in df.columns])


def constraint_violations(spark, sf):
    p = _stored(spark, sf, "id", "hashed_user_id", "predicted_label", *OUTBOX_COLS)
    null = F.lit(None).cast("string")
    proc = _broken(_processed(spark, sf, "id", "original_text", "hashed_user_id", "predicted_label"), "id", {
        "original_text": (7, null), "hashed_user_id": (11, F.concat("hashed_user_id", F.lit("+"))),
        "predicted_label": (13, F.repeat(F.lit("label"), 11))})
    users = _broken(p.select("id", F.lit("").alias("original_text"), "hashed_user_id", "predicted_label"), "id",
                    {"hashed_user_id": (17, null)})
    out = _broken(tables.outbox(p), "id", {"reply_text": (5, null),
                                           "reply_status": (19, F.repeat(F.lit("pending"), 8))})
    met = _broken(p.select("id", F.lit("batch").alias("metric_name"), F.col("id").cast("double").alias("metric_value"),
                           F.col("id").cast("string").alias("batch_id")), "id", {
        "metric_name": (23, null), "metric_value": (29, F.lit(None).cast("double")),
        "batch_id": (31, F.repeat(F.lit("batch"), 21))})
    long = _broken(met, "id", {"metric_name": (37, F.repeat(F.lit("name"), 26))})
    return (decode.constraint_violations(proc, "processed")
            .unionByName(decode.constraint_violations(users, "processed"))
            .unionByName(decode.constraint_violations(out, "outbox"))
            .unionByName(decode.constraint_violations(long, "metrics")))


# ---------------------------------------------------------------- features and classifier

def _training_set(spark, sf):
    """Labelled documents: documents joined with the stand-in labels."""
    docs = tables.read_table(spark, sf, "documents").select("doc_id", "text")
    lab = tables.stand_in_labels(spark, sf).select(F.col("seq").alias("doc_id"),
                                                   F.col("predicted_label").alias("label"))
    return docs.join(lab, "doc_id")


def term_stats(spark, sf):
    return features.term_stats(_training_set(spark, sf))


def tfidf(spark, sf):
    return features.tfidf(_training_set(spark, sf))


def label_encode(spark, sf):
    t = _training_set(spark, sf)
    return t.select("doc_id", "label", features.label_code(F.col("label")).alias("label_code"))


def train_test_split(spark, sf):
    return _training_set(spark, sf).select(
        "doc_id", features.split_column(F.col("doc_id")).alias("split"))


def _predictions(spark, sf):
    t = _training_set(spark, sf).withColumn("label_code", features.label_code(F.col("label"))) \
        .withColumn("split", features.split_column(F.col("doc_id")))
    t = materialize(cart.weight_maps(t.drop("text"), features.tfidf(t)))
    return cart.predict(cart.fit(t.filter(F.col("split") == "train")), t)


def classify(spark, sf):
    return _predictions(spark, sf).select("doc_id", "split", "label", "predicted_label",
                                          F.round("confidence", 6).alias("confidence"))


def classifier_features(spark, sf):
    t = _training_set(spark, sf)
    return clf.feature_rows(clf.featurizer(t), t)


def _stand_in_predictions(spark, sf):
    """Labelled documents with a prediction that is right or not by a keyed hash."""
    t = tables.stand_in_labels(spark, sf).select(F.col("seq").alias("doc_id"), F.col("predicted_label").alias("label"))
    pick = hashing.md5_mod(F.concat(F.lit("predict:"), F.col("doc_id").cast("string")), 10)
    names = [F.lit(x) for x in config.LABELS]
    guess = F.when(pick < 7, F.col("label")).otherwise(F.element_at(F.array(*names), (pick - 6).cast("int")))
    return t.withColumn("predicted_label", guess).withColumn("split", features.split_column(F.col("doc_id")))


def accuracy(spark, sf):
    return clf.accuracy(_stand_in_predictions(spark, sf))


def classification_report(spark, sf):
    return clf.classification_report(_stand_in_predictions(spark, sf).filter(F.col("split") == "test"))


# ---------------------------------------------------------------- privacy

def laplace_noise(spark, sf):
    ev = monitoring.event_counter(_events(spark, sf))
    key = F.concat(F.lit("event_counter|"), F.col("event_type"))
    return ev.select("event_type", F.round(privacy.laplace(key), 6).alias("noise"),
                     privacy.noisy_count(F.col("events_processed_total"), key).alias("noisy_count"))


def noisy_label_summary(spark, sf):
    return privacy.noisy_label_summary(_processed(spark, sf, "predicted_label"))


def private_report(spark, sf):
    return privacy.private_report(_stored(spark, sf, "id", "created_at", "predicted_label", *FLAG_COLS))


def geometric_noise(spark, sf):
    ev = monitoring.event_counter(_events(spark, sf))
    key = F.concat(F.lit("event_counter|"), F.col("event_type"))
    return ev.select("event_type", budget.two_sided_geometric(key).alias("noise"),
                     budget.geometric_count(F.col("events_processed_total"), key).alias("noisy_count"))


def budget_cost(spark, sf):
    """Privacy cost of a daily report on events: types are disjoint parts, users' shares a second section."""
    ev = _events(spark, sf).select(F.date_format("ts", "yyyy-MM-dd").alias("report"), "event_type", "user_id").distinct()
    types = ev.select("report", F.lit("event_type").alias("section"), F.col("event_type").alias("part"), F.lit(0.5).alias("epsilon"))
    users = ev.select("report", F.lit("users").alias("section"), F.lit("all").alias("part"), F.lit(0.25).alias("epsilon")).distinct()
    return budget.report_cost(types.distinct().unionByName(users), ["report"])


# ---------------------------------------------------------------- synthetic messages

def _synth(spark, sf):
    driver = _events(spark, sf).select("event_id")
    docs = tables.read_table(spark, sf, "documents").select(
        F.col("doc_id").alias("seq"), F.col("source").alias("user_id"), F.col("text").alias("message"))
    raw = docs.join(tables.stand_in_labels(spark, sf), "seq", "left")
    inputs = raw.select(F.col("seq").alias("idx"), "user_id", "message",
                        tables.created_at(F.col("seq")).alias("timestamp"),
                        F.col("predicted_label").alias("label"))
    return synth.synthesize(driver, "event_id", inputs)


def synth_messages(spark, sf):
    return _synth(spark, sf)


def synth_label_freq(spark, sf):
    return synth.label_frequency(_synth(spark, sf))


QUERIES: dict[str, Query] = {
    name: fn for name, fn in list(globals().items())
    if callable(fn) and getattr(fn, "__module__", None) == __name__ and not name.startswith("_")
}
