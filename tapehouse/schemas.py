"""Message schemas and table contracts.

Parsing schemas are declared, never inferred. Unknown JSON fields are
dropped from the typed columns and kept in the raw payload column.
"""

from __future__ import annotations

from pyspark.sql.types import (
    LongType,
    StringType,
    StructField,
    StructType,
)

# Field names and types of the feed's messages.
# Envelope shared by order-book messages; ``sequence`` is often absent.
ENVELOPE_SCHEMA = StructType(
    [
        StructField("type", StringType()),
        StructField("product_id", StringType()),
        StructField("time", StringType()),
        StructField("sequence", LongType()),
    ]
)

# Trade message: numerics arrive as strings.
TRADE_MESSAGE_SCHEMA = StructType(
    [
        StructField("trade_id", LongType()),
        StructField("sequence", LongType()),
        StructField("product_id", StringType()),
        StructField("price", StringType()),
        StructField("size", StringType()),
        StructField("side", StringType()),
        StructField("time", StringType()),
    ]
)

# Order-book body: snapshot arrays [[price, size], ...] and update
# changes [[side, price, size], ...], all leaves strings. One schema for
# both shapes lets one parse serve snapshots and updates.
BOOK_BODY_DDL = (
    "struct<bids:array<array<string>>,asks:array<array<string>>,"
    "changes:array<array<string>>>"
)

# These must equal the source system's for compatibility.
# Feed message kinds routed to the order-book stream and to the trade stream,
# the topic names, the key of records without a product, and the namespaces.
BOOK_TYPES = ("snapshot", "l2update")
TRADE_TYPES = ("match", "last_match")
ORDERBOOK_TOPIC = "orderbook_updates"
TRADES_TOPIC = "trades"
UNKNOWN_KEY = "unknown"
NAMESPACES = ("default", "bronze", "silver", "gold")

SILVER_TRADES_COLUMNS = [
    "trade_id", "sequence", "product_id", "price", "size", "side", "time", "ingest_time",
]
SILVER_LEVELS_COLUMNS = ["product_id", "side", "price", "size", "event_time", "sequence"]
LEVEL_KEYS = ["product_id", "side", "price"]

GOLD_OHLCV_COLUMNS = [
    "product_id", "bucket", "open", "high", "low", "close", "volume", "vwap", "trade_count",
]
GOLD_TOP_OF_BOOK_COLUMNS = ["product_id", "best_bid", "best_ask", "spread"]

# DDL for the layer tables (fixed values: names and column contracts). ``{using}`` is filled by the table helpers
# (parquet here; iceberg/delta where their catalogs are configured).
TABLE_DDL = {
    "bronze.orderbook_events": (
        "type STRING, product_id STRING, time STRING, sequence BIGINT, "
        "payload STRING, ingest_time TIMESTAMP"
    ),
    "bronze.trades": (
        "trade_id BIGINT, sequence BIGINT, product_id STRING, price DOUBLE, size DOUBLE, "
        "side STRING, time TIMESTAMP, raw_payload STRING, ingest_time TIMESTAMP"
    ),
    "silver.stg_trades": (
        "trade_id BIGINT, sequence BIGINT, product_id STRING, price DOUBLE, size DOUBLE, "
        "side STRING, time TIMESTAMP, ingest_time TIMESTAMP"
    ),
    "silver.stg_orderbook_levels": (
        "product_id STRING, side STRING, price DOUBLE, size DOUBLE, "
        "event_time TIMESTAMP, sequence BIGINT"
    ),
    "gold.gold_ohlcv_1min": (
        "product_id STRING, bucket TIMESTAMP, open DOUBLE, high DOUBLE, low DOUBLE, "
        "close DOUBLE, volume DOUBLE, vwap DOUBLE, trade_count BIGINT"
    ),
    "gold.gold_top_of_book": (
        "product_id STRING, best_bid DOUBLE, best_ask DOUBLE, spread DOUBLE"
    ),
}

# Partition columns of the layer tables as Parquet folders (a type where the column is derived).
FILE_PARTITIONS = {
    "silver.stg_trades": "time_date DATE",
    "silver.stg_orderbook_levels": "product_id",
    "gold.gold_ohlcv_1min": "bucket_date DATE",
}

# Day-partitioned bronze tables: table -> timestamp column of the day. Both
# use the ingest day, which the incremental silver reads filter on.
DAY_PARTITIONS = {
    "bronze.orderbook_events": "ingest_time",
    "bronze.trades": "ingest_time",
}

