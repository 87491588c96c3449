"""Keyed JSON publishing of feed records (Kafka-shaped key/value rows)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapehouse.schemas import UNKNOWN_KEY

# JSON renders timestamps at millisecond precision by default; keep micros.
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def publish_records(
    df: DataFrame,
    key: str = "product_id",
    order: Sequence[str] | None = None,
    whole_keys: bool = True,
) -> DataFrame:
    """Rows to (key, value): key = the key column or 'unknown', value = the row as JSON.

    With ``order``, rows are clustered by key and sorted by ``order`` within
    each task, so a sink that keeps per-writer order (Kafka partitions by
    key) receives every key in order. That ordering is inherently serial
    per key; without ``order`` the publish is fully parallel.

    ``whole_keys=False`` is for sinks that keep the order of the tasks, such
    as files named by them: rows are dealt by ranges of (key, order), so a
    key with a third of all rows spreads over consecutive tasks, each sorted.
    """
    out = df.select(
        F.coalesce(F.col(key).cast("string"), F.lit(UNKNOWN_KEY)).alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_OPTIONS).alias("value"),
        *([F.col(c).alias(f"_o{i}") for i, c in enumerate(order)] if order else []),
    )
    if order:
        okeys = [f"_o{i}" for i in range(len(order))]
        dealt = out.repartition("key") if whole_keys else out.repartitionByRange("key", *okeys)
        out = dealt.sortWithinPartitions("key", *okeys).drop(*okeys)
    return out


#: The producer's settings, under which a key's order outlives a resend.
DURABLE = {"kafka.acks": "all", "kafka.retries": "5", "kafka.max.in.flight.requests.per.connection": "1"}


def producer_options(bootstrap_servers: str, topic: str, options: Mapping[str, str]) -> dict[str, str]:
    """Options of a Kafka sink: the durable settings unless ``options`` say otherwise."""
    return {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic, **DURABLE, **options}


def write_kafka(records: DataFrame, topic: str, bootstrap_servers: str, **options: str) -> None:
    """Batch publish (key, value) rows to a Kafka topic (needs the Kafka connector)."""
    writer = records.select("key", "value").write.format("kafka")
    writer.options(**producer_options(bootstrap_servers, topic, options)).save()


def write_ordered_feed_files(df: DataFrame, path: str, order: Sequence[str], key: str = "product_id", mode: str = "append") -> None:
    """One JSON message per line, ordered by (key, order) over the files of this write in the order of
    their names. A key with most rows spreads over several files."""
    write_feed_files(publish_records(df, key, order, whole_keys=False), path, mode)


def write_feed_files(records: DataFrame, path: str, mode: str = "append") -> None:
    """File twin of the Kafka topic: one JSON message per line (the ``value``)."""
    records.select(F.col("value")).write.mode(mode).text(path)


def start_kafka_stream(records: DataFrame, topic: str, bootstrap_servers: str, checkpoint: str, **options: str):
    """Streaming publish of (key, value) rows to a Kafka topic (needs the Kafka connector)."""
    w = records.select("key", "value").writeStream.format("kafka")
    return w.options(**producer_options(bootstrap_servers, topic, options)).option("checkpointLocation", checkpoint).start()
