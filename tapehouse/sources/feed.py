"""Feed sources: Kafka topics, or their file twins (one JSON message per line).

Both return a DataFrame with a ``value`` column holding the raw message,
plus an arrival-order column (``offset`` for Kafka). Batch and streaming
variants share the downstream operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapehouse.schemas import ORDERBOOK_TOPIC, TRADES_TOPIC  # noqa: F401  (re-exported)


def kafka_stream(
    spark: SparkSession,
    topic: str,
    bootstrap_servers: str,
    starting_offsets: str = "earliest",
    **options: str,
) -> DataFrame:
    """Streaming Kafka scan of one topic (needs the spark-sql-kafka connector).

    ``startingOffsets`` only applies to the first start; afterwards the
    query's checkpoint decides where to resume.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def kafka_batch(
    spark: SparkSession, topic: str, bootstrap_servers: str, **options: str
) -> DataFrame:
    """Batch Kafka scan (backfill) of one topic, earliest to latest."""
    reader = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
    )
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of JSON-lines feed files: one ``value`` string per line."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def file_batch(spark: SparkSession, path: str) -> DataFrame:
    """Batch scan of the same JSON-lines feed files."""
    return spark.read.format("text").load(path)
