"""Streaming sources (wire records as a ``value`` string column) and the publisher sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = 1) -> DataFrame:
    """One JSON record per line in text files dropped into ``path`` (broker-free source)."""
    reader = spark.readStream.schema("value string")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def parquet_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Rows of a parquet table (one file or a folder of files), as they stand when a trigger fires.

    The last letter is given as a pattern: a file stream takes a single file only by a pattern."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def kafka_stream(spark: SparkSession, bootstrap: str, topic: str,
                 starting_offsets: str = "earliest",
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Kafka topic as (value string, partition, offset); needs the Kafka connector on the classpath."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select(F.col("value").cast("string").alias("value"), "partition", "offset")


def read_csv_messages(spark: SparkSession, path: str) -> DataFrame:
    """Raw message CSV (header user_id,message,timestamp,label), all strings, no inference."""
    schema = "user_id string, message string, timestamp string, label string"
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE") \
        .option("multiLine", True).option("escape", '"').csv(path)


def write_csv_messages(df: DataFrame, path: str) -> None:
    df.select("user_id", "message", "timestamp", "label").write.mode("overwrite") \
        .option("header", True).option("escape", '"').csv(path)


def publish_files(df: DataFrame, path: str, cols: list[str]) -> None:
    """Publisher for tests and batch replays: JSON lines of the given columns."""
    df.select(F.to_json(F.struct(*[F.col(c) for c in cols])).alias("value")) \
        .write.mode("overwrite").text(path)


def publish_kafka(df: DataFrame, bootstrap: str, topic: str, cols: list[str],
                  retries: int = 3) -> None:
    """Batch publish to Kafka (acks=all, producer retries); needs the Kafka connector jar."""
    (df.select(F.to_json(F.struct(*[F.col(c) for c in cols])).alias("value"))
     .write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
     .option("kafka.acks", "all").option("kafka.retries", str(retries))
     .option("topic", topic).save())
