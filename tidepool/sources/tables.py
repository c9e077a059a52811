"""Readers for the driver's parquet tables and the role frames derived from them.

Roles (deterministic, so an SQL engine can derive the same rows):

* raw messages: ``documents`` with ``seq = doc_id``, ``user_id = source``, ``message = text``;
* processed: raw messages flagged (Bloom exact flag, near flag), labelled from ``labels``
  (toxic -> complaint, quality 0 -> inquiry, quality 1 -> praise, unlabelled -> NULL), with
  ``confidence = (n_chars % 101) / 100`` and ``created_at = 2024-01-01 + seq seconds``;
* outbox: one pending reply per processed row;
* metrics: per-batch counters, batch = seq div ``BATCH_ROWS``.
"""

from __future__ import annotations

import os

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool import config
from tidepool.functions import hashing
from tidepool.operators import dedup, replies

BATCH_ROWS = 100
EPOCH_START = "2024-01-01 00:00:00"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Round-robin a small input over all cores before CPU-heavy text work.

    Only when the input has fewer partitions than task slots (small inputs); a large input
    already has far more splits than slots and is left untouched (no shuffle). ``partitions``
    may be passed when known, to avoid planning ``df`` just to count them.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    n = partitions if partitions is not None else df.rdd.getNumPartitions()
    if n < slots:
        return df.repartition(slots)
    return df


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("seq"), F.col("source").alias("user_id"),
        F.col("text").alias("message"), "n_chars"))


def label_from_flags(quality, toxic):
    return (F.when(toxic == 1, F.lit("complaint"))
            .when(quality == 0, F.lit("inquiry"))
            .when(quality == 1, F.lit("praise")))


def stand_in_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = read_table(spark, sf_dir, "labels")
    return lab.select(F.col("doc_id").alias("seq"),
                      label_from_flags(F.col("quality"), F.col("toxic")).alias("predicted_label"))


def created_at(seq) -> "F.Column":
    """2024-01-01 00:00:00 + seq seconds (days and seconds apart, so any long id fits)."""
    days = F.floor(seq / F.lit(86400)).cast("int")
    secs = (seq - days.cast("bigint") * F.lit(86400)).cast("decimal(18,6)")
    return F.to_timestamp_ntz(F.lit(EPOCH_START)) + F.make_dt_interval(days=days, secs=secs)


FLAGS = ("is_duplicate", "is_near_duplicate")
PROCESSED = ("id", "original_text", "cleaned_text", "hashed_user_id", "predicted_label", "confidence",
             *FLAGS, "created_at", "reply_text", "updated_at")


def flags(spark: SparkSession, sf_dir: str, bloom_size: int = config.BLOOM_SIZE) -> DataFrame:
    """(id, is_duplicate, is_near_duplicate) of every message."""
    return dedup.flag_messages(raw_messages(spark, sf_dir).select("seq", "message"), size=bloom_size) \
        .select(F.col("seq").alias("id"), *FLAGS)


def processed(spark: SparkSession, sf_dir: str, columns: Sequence[str] = PROCESSED,
              bloom_size: int = config.BLOOM_SIZE, only: DataFrame | None = None) -> DataFrame:
    """``columns`` of the processed-messages table (see module docstring), built from just the
    parts they need: labels are joined for a label or reply, flags computed for a flag.

    ``only``: ids (column ``id``, a few rows) to which text and labels are restricted before the
    joins; the flags themselves always follow from all messages.
    """
    need = set(columns)
    docs = read_table(spark, sf_dir, "documents")
    out = docs.select(F.col("doc_id").alias("id"), "source", "text", "n_chars")
    if only is not None:
        out = out.join(F.broadcast(only.select("id")), "id", "left_semi")
    if need & {"predicted_label", "reply_text"}:
        labels = stand_in_labels(spark, sf_dir).withColumnRenamed("seq", "id")
        out = out.join(labels, "id", "left")
    if need & set(FLAGS):
        found = flags(spark, sf_dir, bloom_size)
        if only is not None:
            found = found.join(F.broadcast(only.select("id")), "id", "left_semi")
        out = out.join(found, "id", "inner")
    conf = (F.col("n_chars") % 101).cast("double") / F.lit(100.0)
    made = {"original_text": F.col("text"), "cleaned_text": F.col("text"),
            "hashed_user_id": hashing.user_hash(F.col("source")), "confidence": conf,
            "created_at": created_at(F.col("id")), "updated_at": created_at(F.col("id")),
            "reply_text": replies.reply_text(F.col("predicted_label"), conf)
            if need & {"predicted_label", "reply_text"} else None}
    return out.select(*[made[c].alias(c) if c in made else F.col(c) for c in PROCESSED if c in need])


def outbox(processed_df: DataFrame) -> DataFrame:
    return replies.build_outbox(processed_df)


def metrics(processed_df: DataFrame, batch_rows: int = BATCH_ROWS) -> DataFrame:
    from tidepool.operators import monitoring
    batched = processed_df.withColumn("epoch", F.expr(f"id div {int(batch_rows)}"))
    return monitoring.batch_metrics(batched, epoch="epoch")


#: One record per decode rule: kept, defaults, every reject reason, text after the value.
WIRE_EDGES = (
    '{"message":"kept","user_id":"u1"}', '{"user_id":"u2"}', '{"message":"no user"}', "{}",
    '{"message":null}', '{"message":5}', '{"message":["x"]}', '{"message":"a","user_id":null}',
    '{"message":"a","user_id":7}', "[1,2]", '"text"', "12", "true", "bad{", "", None,
    '{"message":"a"} x', '{"message":"a"}{"message":"b"}', '{"message":"a"},{"message":"b"}',
    '{"message":"a"}}', '{"message":"a"} ', ' {"message":"spaces around"} ',
)


def wire_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON wire stream built from the driver tables (origin, src_id, part, value).

    documents -> {"user_id", "message"}; conversations -> {"conv_id", "turn", "role", "message"}
    (no user id); events -> {"user_id": <number>, "message"}; events.props -> {"k": n} (no
    message); pages.html -> not JSON. ``edges`` adds one record per parsing rule.
    """
    from tidepool.operators.decode import encode
    docs = encode(read_table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("origin"), F.col("doc_id").alias("src_id"),
        F.lit(0).cast("bigint").alias("part"), F.col("source").alias("user_id"),
        F.col("text").alias("message")), ["user_id", "message"])
    conv = encode(read_table(spark, sf_dir, "conversations").select(
        F.lit("conversations").alias("origin"), F.col("conv_id").alias("src_id"),
        F.col("turn").alias("part"), "conv_id", "turn", "role", F.col("text").alias("message")),
        ["conv_id", "turn", "role", "message"])
    ev = read_table(spark, sf_dir, "events")
    evs = encode(ev.select(F.lit("events").alias("origin"), F.col("event_id").alias("src_id"),
                           F.lit(0).cast("bigint").alias("part"), "user_id",
                           F.col("event_type").alias("message")), ["user_id", "message"])
    props = ev.select(F.lit("props").alias("origin"), F.col("event_id").alias("src_id"),
                      F.lit(0).cast("bigint").alias("part"), F.col("props").alias("value"))
    pages = read_table(spark, sf_dir, "pages").select(
        F.lit("pages").alias("origin"), F.col("page_id").alias("src_id"),
        F.lit(0).cast("bigint").alias("part"), F.col("html").alias("value"))
    cols = ["origin", "src_id", "part", "value"]
    edges = spark.createDataFrame(
        [("edges", i, 0, v) for i, v in enumerate(WIRE_EDGES)],
        "origin string, src_id bigint, part bigint, value string")
    return (docs.select(*cols).unionByName(conv.select(*cols)).unionByName(evs.select(*cols))
            .unionByName(props).unionByName(pages).unionByName(edges))
