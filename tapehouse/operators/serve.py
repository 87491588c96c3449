"""Serving queries over gold/silver tables: resampled bars, last N bars,
order-book ladders, a rolling ticker and the recent-trade tape.

Every function is lazy and returns at most a bounded number of rows per
product where that bound is the feature (depth, N, tape length). A client
collects only the final small frame.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapehouse.functions import bar_direction, lookback, pct_change, safe_divide


def _ts(value: Column | str | datetime) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        return F.lit(value)
    return F.lit(value).cast("timestamp")


def resample(bars: DataFrame, rule: str) -> DataFrame:
    """Re-aggregate bars to a coarser epoch-aligned interval (e.g. "1 hour").

    open is the first non-null open, close the last non-null close, high
    max, low min, volume and trade_count sums; vwap is re-weighted by
    volume (null for zero volume). Bins without an open are dropped.
    """
    b = F.col("bucket")
    open_at = F.when(F.col("open").isNotNull(), F.unix_micros(b.cast("timestamp")))
    close_at = F.when(F.col("close").isNotNull(), F.unix_micros(b.cast("timestamp")))
    return (
        bars.groupBy("product_id", F.window(b, rule).start.alias("bucket"))
        .agg(
            F.min_by("open", open_at).alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", close_at).alias("close"),
            F.sum("volume").alias("volume"),
            F.sum("trade_count").alias("trade_count"),
            safe_divide(F.sum(F.col("vwap") * F.col("volume")), F.sum("volume")).alias("vwap"),
        )
        .where(F.col("open").isNotNull())
    )


def last_bars(bars: DataFrame, n: int = 100) -> DataFrame:
    """The newest ``n`` bars of every product (a top-n per product)."""
    w = Window.partitionBy("product_id").orderBy(F.col("bucket").desc())
    return bars.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def with_direction(bars: DataFrame) -> DataFrame:
    """Add ``direction``: 'up' when close >= open, else 'down'."""
    return bars.withColumn("direction", bar_direction("open", "close"))


def ladder(levels: DataFrame, depth: int = 10, product_id: str | None = None) -> DataFrame:
    """Top ``depth`` active levels per (product_id, side), of one product when given.

    Bids by price descending, asks ascending; ``level`` is 1-based. One
    window serves both sides by ranking on a signed price, and Spark cuts
    each side to ``depth`` rows per map partition before the shuffle.
    """
    if product_id is not None:
        levels = levels.where(F.col("product_id") == product_id)
    rank_price = F.when(F.col("side") == "buy", -F.col("price")).otherwise(F.col("price"))
    w = Window.partitionBy("product_id", "side").orderBy(
        rank_price.asc_nulls_last(), F.col("size").desc_nulls_last()
    )
    return (
        levels.where((F.col("size") > 0) & F.col("side").isin("buy", "sell"))
        .withColumn("level", F.row_number().over(w).cast("bigint"))
        .where(F.col("level") <= depth)
        .select("product_id", "side", "level", "price", "size")
    )


def ladder_spread(ladder_df: DataFrame) -> DataFrame:
    """Best ask minus best bid from level 1 of a ladder; null unless both sides exist."""
    top = ladder_df.where(F.col("level") == 1)
    return top.groupBy("product_id").agg(
        (
            F.max(F.when(F.col("side") == "sell", F.col("price")))
            - F.max(F.when(F.col("side") == "buy", F.col("price")))
        ).alias("spread")
    )


def ticker(
    bars: DataFrame,
    asof: Column | str | datetime,
    window: timedelta = timedelta(hours=24),
    product_id: str | None = None,
) -> DataFrame:
    """Rolling ticker per product (or of one) over bars with ``bucket >= asof - window``.

    last_price is the close of the newest bar, first_close the close of the
    oldest (the change is close-to-close), change_pct guards a zero first
    close with 0.0; high/low/volume are max/min/sum.
    """
    if product_id is not None:
        bars = bars.where(F.col("product_id") == product_id)
    cutoff = lookback(_ts(asof), window)
    b = F.unix_micros(F.col("bucket").cast("timestamp"))
    return (
        bars.where(F.col("bucket") >= cutoff)
        .groupBy("product_id")
        .agg(
            F.max_by("close", b).alias("last_price"),
            F.min_by("close", b).alias("first_close"),
            F.max("high").alias("high_24h"),
            F.min("low").alias("low_24h"),
            F.sum("volume").alias("volume_24h"),
        )
        .withColumn("change_pct", pct_change("first_close", "last_price"))
    )


def ticker_24h(bars: DataFrame, asof: Column | str | datetime, product_id: str | None = None) -> DataFrame:
    return ticker(bars, asof, timedelta(hours=24), product_id)


def latest_bucket(trades: DataFrame, interval_seconds: int = 60, time_col: str = "time") -> Column:
    """Scalar subquery: start of the newest bar, i.e. ``max(bucket)`` of
    ``ohlcv(trades, interval)``, computed from ``max(time)`` alone (a
    one-column scan instead of a second bar aggregation). Keeps the
    timestamp flavour of ``time_col``.
    """
    dtype = trades.schema[time_col].dataType
    step = interval_seconds * 1_000_000
    micros = F.unix_micros(F.max(time_col).cast("timestamp"))
    start = F.timestamp_micros(micros - F.pmod(micros, F.lit(step)))
    return trades.select(start.cast(dtype).alias("asof")).scalar()


def bars_lookback(minutes_per_bar: int, bars: int) -> timedelta:
    """Lookback for a chart of ``bars`` bars: 1.2 times the span they cover."""
    return timedelta(minutes=minutes_per_bar * bars * 1.2)


def chart_bars(
    bars: DataFrame,
    asof: Column | str | datetime,
    rule: str = "1 hour",
    minutes_per_bar: int = 60,
    n: int = 100,
    product_id: str | None = None,
) -> DataFrame:
    """Bars for a price chart: minute bars since ``asof - lookback``, resampled
    to ``rule``, the newest ``n`` per product, with their direction.

    The lookback is 1.2 times the span of ``n`` bars; the product and time
    filters are plain predicates, so they reach the scan of a stored table.
    """
    src = bars.where(F.col("bucket") >= lookback(_ts(asof), bars_lookback(minutes_per_bar, n)))
    if product_id is not None:
        src = src.where(F.col("product_id") == product_id)
    return with_direction(last_bars(resample(src, rule), n))


def recent_trades(
    trades: DataFrame,
    since: Column | str | datetime,
    n: int = 30,
    product_id: str | None = None,
) -> DataFrame:
    """The newest ``n`` trades per product with ``time >= since`` (the tape).

    Newest first by time, then trade_id. Columns: product_id, time, side,
    price, size, trade_id.
    """
    src = trades.where(F.col("time") >= _ts(since))
    if product_id is not None:
        src = src.where(F.col("product_id") == product_id)
    w = Window.partitionBy("product_id").orderBy(F.col("time").desc(), F.col("trade_id").desc())
    return (
        src.withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") <= n)
        .select("product_id", "time", "side", "price", "size", "trade_id")
    )
