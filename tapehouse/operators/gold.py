"""Gold layer: time bars and top of book, rebuilt from silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapehouse.functions import order_key, safe_divide
from tapehouse.schemas import GOLD_OHLCV_COLUMNS, GOLD_TOP_OF_BOOK_COLUMNS


def ohlcv(trades: DataFrame, interval: str = "1 minute", time_col: str = "time") -> DataFrame:
    """OHLCV + VWAP bars per (product_id, bucket).

    open/close are the prices of the first/last trade in the bucket by
    (time, trade_id), a null id before all others: ``min_by``/``max_by`` over
    one exact DECIMAL key of both, for every row alike. The bar is one scan
    and one hash aggregation with partial aggregation before its only
    shuffle. ``bucket`` is the start of the epoch-aligned interval and keeps
    the timestamp type of ``time_col``. vwap is null when the bucket's volume
    is 0. Rows without a time have no bar.
    """
    t = F.col(time_col)
    order = order_key(t, F.col("trade_id"))
    price, size = F.col("price"), F.col("size")
    return (
        trades.withColumn("_bucket", F.window(t, interval).start)
        .groupBy("product_id", F.col("_bucket").alias("bucket"))
        .agg(
            F.min_by(price, order).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, order).alias("close"),
            F.sum(size).alias("volume"),
            safe_divide(F.sum(price * size), F.sum(size)).alias("vwap"),
            F.count(F.lit(1)).alias("trade_count"),
        )
        .select(*GOLD_OHLCV_COLUMNS)
    )


def top_of_book(levels: DataFrame) -> DataFrame:
    """Best bid (max buy price), best ask (min sell price) and spread per product.

    Only active levels (size > 0) count. A one-sided book gives a null side
    and a null spread.
    """
    side, price = F.col("side"), F.col("price")
    return (
        levels.where(F.col("size") > 0)
        .groupBy("product_id")
        .agg(
            F.max(F.when(side == "buy", price)).alias("best_bid"),
            F.min(F.when(side == "sell", price)).alias("best_ask"),
        )
        .withColumn("spread", F.col("best_ask") - F.col("best_bid"))
        .select(*GOLD_TOP_OF_BOOK_COLUMNS)
    )
