"""Bronze layer: raw feed messages to typed rows, raw text kept.

Inputs are any DataFrame with a message column (Kafka ``value`` as binary,
or a string column from a file source). All functions are stateless
projections, so they work on batch and streaming DataFrames alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tapehouse.functions import to_double, to_timestamp_or_null
from tapehouse.schemas import BOOK_TYPES, ENVELOPE_SCHEMA, TRADE_MESSAGE_SCHEMA, TRADE_TYPES


def _ingest(ingest_time: Column | str | None) -> Column:
    if ingest_time is None:
        # Constant within a micro-batch / a batch query.
        return F.current_timestamp()
    return F.col(ingest_time) if isinstance(ingest_time, str) else ingest_time


def _parse_once(raw: DataFrame, parsed: Column, *cols: Column) -> DataFrame:
    """Project ``cols`` and ``parsed`` (a ``from_json``), the latter through a one-element ``inline``.

    The optimizer pushes filters on parsed fields below a plain projection
    and inlines ``from_json`` into every predicate, re-parsing each message
    once per referenced field. Such filters cannot cross the Generate node
    that ``inline`` makes, so the JSON is parsed exactly once per row. The
    other columns stay outside it: a filter on them reaches the scan, and
    rows it drops are never parsed.
    """
    return raw.select(*cols, F.inline(F.array(F.struct(parsed))))


def parse_orderbook(
    raw: DataFrame,
    value_col: str = "value",
    ingest_time: Column | str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Order-book envelope: type, product_id, time (string), sequence, payload, ingest_time.

    Malformed JSON gives null envelope fields; the payload is kept. ``keep``
    passes source columns through (e.g. a Kafka offset).
    """
    payload = F.col(value_col).cast("string")
    return _parse_once(
        raw,
        F.from_json(payload, ENVELOPE_SCHEMA).alias("_env"),
        payload.alias("payload"),
        _ingest(ingest_time).alias("ingest_time"),
        *[F.col(k) for k in keep],
    ).select(
        F.col("_env.type").alias("type"),
        F.col("_env.product_id").alias("product_id"),
        F.col("_env.time").alias("time"),
        F.col("_env.sequence").alias("sequence"),
        "payload",
        "ingest_time",
        *keep,
    )


def parse_trades(
    raw: DataFrame,
    value_col: str = "value",
    ingest_time: Column | str | None = None,
    keep: Sequence[str] = (),
    time_type: DataType | None = None,
) -> DataFrame:
    """Trade messages to the bronze trades schema; numerics and time parsed null-safely.

    ``time_type`` casts the parsed time (default TIMESTAMP) e.g. to
    TIMESTAMP_NTZ; ``keep`` passes source columns through.
    """
    payload = F.col(value_col).cast("string")
    return _parse_once(
        raw,
        F.from_json(payload, TRADE_MESSAGE_SCHEMA).alias("_d"),
        payload.alias("raw_payload"),
        _ingest(ingest_time).alias("ingest_time"),
        *[F.col(k) for k in keep],
    ).select(
        F.col("_d.trade_id").alias("trade_id"),
        F.col("_d.sequence").alias("sequence"),
        F.col("_d.product_id").alias("product_id"),
        to_double("_d.price").alias("price"),
        to_double("_d.size").alias("size"),
        F.col("_d.side").alias("side"),
        to_timestamp_or_null("_d.time", time_type).alias("time"),
        "raw_payload",
        "ingest_time",
        *keep,
    )


def message_type(value_col: str = "value") -> Column:
    """The ``type`` field of a raw feed message (null when malformed)."""
    return F.get_json_object(F.col(value_col).cast("string"), "$.type")


def route_label(type_col: Column | str = "type") -> Column:
    """'orderbook' for book messages, 'trades' for matches, null for the rest."""
    t = F.col(type_col) if isinstance(type_col, str) else type_col
    return (
        F.when(t.isin(*BOOK_TYPES), F.lit("orderbook"))
        .when(t.isin(*TRADE_TYPES), F.lit("trades"))
    )


def route_feed(raw: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split one raw feed into (order-book messages, trade messages).

    Heartbeats, subscription confirmations and errors are dropped. Both
    outputs keep the input columns; parse them with ``parse_orderbook`` and
    ``parse_trades``.
    """
    typed = raw.withColumn("_type", message_type(value_col))
    book = typed.where(F.col("_type").isin(*BOOK_TYPES)).drop("_type")
    trades = typed.where(F.col("_type").isin(*TRADE_TYPES)).drop("_type")
    return book, trades


# The envelope parser under its layer-neutral name.
parse_envelope = parse_orderbook
