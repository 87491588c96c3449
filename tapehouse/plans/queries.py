"""Registered queries: each takes (spark, sf_dir) and returns a lazy DataFrame.

Every query reads the driver's tables whole (through the fixture views)
and runs the library operators on them. ``QUERIES`` maps names to
callables; the matching DuckDB SQL lives in ``tapehouse.plans.oracle``.
Ratios that sum doubles in an engine-dependent order (vwap) are rounded
to 10 decimals for the cross-engine comparison only.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from tapehouse.operators import bronze, gold, quality, serve, silver, upsert
from tapehouse.plans import fixtures as fx
from tapehouse.functions import lookback
from tapehouse.plans.layers import Lake, run_all
from tapehouse.session import scratch_path
from tapehouse.sources.feed import file_stream
from tapehouse.sources.publish import JSON_OPTIONS, publish_records, write_feed_files
from tapehouse.sources.tables import full_refresh, scan, write_day_partitioned
from tapehouse.streaming import bronze as streaming
from tapehouse.streaming.bronze import start_append
from tapehouse.streaming.gaps import stream_sequence_gaps

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NTZ = TimestampNTZType()
# Fixed split points of the two-run (first load, then incremental) cases.
FIRST_RUN_END = "2024-01-16 00:00:00"
CORRECTION_START = "2024-01-16 00:00:00"
TARGET_END = "2024-01-19 00:00:00"
BOOK_SECOND_START = "2024-01-12 00:00:00"
TRADE_RECORD_DDL = (
    "trade_id BIGINT, sequence BIGINT, product_id STRING, price DOUBLE, size DOUBLE, "
    "side STRING, time TIMESTAMP_NTZ, ingest_time TIMESTAMP_NTZ"
)


def query(name: str) -> Callable[[Query], Query]:
    """Register a query. Feed times are UTC instants, so the session zone is pinned to UTC."""

    def register(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            if spark.conf.get("spark.sql.session.timeZone") != "UTC":
                spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[name] = run
        return run

    return register


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory for one query run."""
    return scratch_path(spark, f"queries/{name}-{uuid.uuid4().hex}")


def _round_vwap(df: DataFrame) -> DataFrame:
    return df.withColumn("vwap", F.round("vwap", 10))


def _ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


# ---- sources shared by several queries ---------------------------------

def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.trades_view(fx.events(spark, sf_dir))


def minute_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.ohlcv(trades(spark, sf_dir), "1 minute")


def bronze_trades(spark: SparkSession, sf_dir: str, redeliver: bool = False) -> DataFrame:
    feed = fx.trade_feed(fx.events(spark, sf_dir), redeliver=redeliver)
    return bronze.parse_trades(feed, ingest_time="ingest_time", time_type=NTZ)


def bronze_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = fx.book_feed(fx.events(spark, sf_dir))
    return bronze.parse_orderbook(feed, ingest_time="ingest_time", keep=["msg_offset"])


def book_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.latest_levels(silver.flatten_levels(bronze_book(spark, sf_dir)))


# ---- gold bars ----------------------------------------------------------

@query("ohlcv_1min")
def q_ohlcv_1min(spark, sf_dir):
    return _round_vwap(gold.ohlcv(trades(spark, sf_dir), "1 minute"))


@query("ohlcv_1h")
def q_ohlcv_1h(spark, sf_dir):
    return _round_vwap(gold.ohlcv(trades(spark, sf_dir), "1 hour"))


@query("ohlcv_1d")
def q_ohlcv_1d(spark, sf_dir):
    """Daily bars whose order needs the ids: times cut to the hour, ids far above 2^63 / 1 day
    in microseconds, negative ids, and null ids (at their own times)."""
    t = trades(spark, sf_dir)
    eid = F.col("trade_id")
    odd = t.select(
        F.when(eid % 97 == 0, F.lit(None)).when(eid % 3 == 0, -eid).otherwise(eid + F.lit(4 * 10**18)).alias("trade_id"),
        "product_id", "price", "size",
        F.when(eid % 97 == 0, F.col("time")).otherwise(F.date_trunc("hour", "time").cast("timestamp_ntz")).alias("time"),
    )
    return _round_vwap(gold.ohlcv(odd, "1 day"))


@query("ohlcv_resample_1h")
def q_resample_1h(spark, sf_dir):
    return _round_vwap(serve.resample(minute_bars(spark, sf_dir), "1 hour"))


@query("ohlcv_resample_2h")
def q_resample_2h(spark, sf_dir):
    return _round_vwap(serve.resample(minute_bars(spark, sf_dir), "2 hours"))


@query("last_bars")
def q_last_bars(spark, sf_dir):
    return _round_vwap(serve.last_bars(minute_bars(spark, sf_dir), 100))


@query("bar_direction")
def q_bar_direction(spark, sf_dir):
    bars = serve.with_direction(minute_bars(spark, sf_dir))
    return bars.select("product_id", "bucket", "open", "close", "direction")


@query("chart_bars")
def q_chart_bars(spark, sf_dir):
    t = trades(spark, sf_dir)
    bars = gold.ohlcv(t, "1 minute")
    out = serve.chart_bars(bars, serve.latest_bucket(t, 60), rule="1 hour", minutes_per_bar=60, n=100)
    return _round_vwap(out)


@query("ticker_24h")
def q_ticker_24h(spark, sf_dir):
    t = trades(spark, sf_dir)
    return serve.ticker_24h(gold.ohlcv(t, "1 minute"), serve.latest_bucket(t, 60))


@query("recent_trades")
def q_recent_trades(spark, sf_dir):
    t = trades(spark, sf_dir)
    asof = t.select(F.max("time")).scalar()
    since = lookback(asof, serve.bars_lookback(60, 100))
    return serve.recent_trades(t, since, n=30)


# ---- silver trades -----------------------------------------------------

@query("trade_parse")
def q_trade_parse(spark, sf_dir):
    return bronze_trades(spark, sf_dir).drop("raw_payload")


@query("parse_malformed")
def q_parse_malformed(spark, sf_dir):
    feed = fx.malformed_trade_feed(fx.events(spark, sf_dir))
    b = bronze.parse_trades(feed, ingest_time="ingest_time", keep=["msg_offset"], time_type=NTZ)
    return b.select(
        "msg_offset", "trade_id", "product_id", "price", "size", "time",
        F.coalesce("time", "ingest_time").alias("event_time"),
    )


@query("trades_dedup")
def q_trades_dedup(spark, sf_dir):
    return silver.clean_trades(bronze_trades(spark, sf_dir, redeliver=True))


@query("trades_incremental")
def q_trades_incremental(spark, sf_dir):
    b = bronze_trades(spark, sf_dir)
    first = silver.clean_trades(b.where(F.col("ingest_time") < _ts(FIRST_RUN_END)))
    return silver.clean_trades(b, target=first)


@query("trades_upsert")
def q_trades_upsert(spark, sf_dir):
    t = trades(spark, sf_dir)
    target = t.where(F.col("time") < _ts(TARGET_END))
    source = t.where(F.col("time") >= _ts(CORRECTION_START)).withColumn("price", F.col("price") + 1)
    return upsert.upsert(target, source, ["trade_id"])


# ---- order book --------------------------------------------------------

@query("envelope_parse")
def q_envelope_parse(spark, sf_dir):
    return bronze_book(spark, sf_dir).drop("payload")


@query("levels_flatten")
def q_levels_flatten(spark, sf_dir):
    return silver.flatten_levels(bronze_book(spark, sf_dir))


@query("levels_latest")
def q_levels_latest(spark, sf_dir):
    return book_levels(spark, sf_dir)


@query("levels_incremental")
def q_levels_incremental(spark, sf_dir):
    b = bronze_book(spark, sf_dir)
    first = silver.silver_levels(b.where(F.col("ingest_time") < _ts(FIRST_RUN_END)))
    second = silver.silver_levels(b, target=first)
    return upsert.upsert(first, second, ["product_id", "side", "price"])


@query("levels_upsert")
def q_levels_upsert(spark, sf_dir):
    b = bronze_book(spark, sf_dir)
    target = silver.silver_levels(b.where(F.col("ingest_time") < _ts(FIRST_RUN_END)))
    source = silver.silver_levels(b.where(F.col("ingest_time") >= _ts(BOOK_SECOND_START)))
    return upsert.upsert(target, source, ["product_id", "side", "price"])


LATE_BATCH_START = "2024-01-05 00:00:00"
LATE_BATCH_END = "2024-01-12 00:00:00"


@query("levels_upsert_guarded")
def q_levels_upsert_guarded(spark, sf_dir):
    """A late batch (older messages re-sent) merged into the whole book with the newer-by
    guard: stored levels that are newer than the late rows are kept."""
    b = bronze_book(spark, sf_dir)
    target = silver.silver_levels(b)
    late = b.where((F.col("ingest_time") >= _ts(LATE_BATCH_START)) & (F.col("ingest_time") < _ts(LATE_BATCH_END)))
    return upsert.upsert(target, silver.silver_levels(late), ["product_id", "side", "price"],
                         newer_by=["event_time", "sequence"])


@query("levels_upsert_delete_removed")
def q_levels_upsert_delete_removed(spark, sf_dir):
    """The upsert with removed levels (size 0) deleted instead of kept."""
    b = bronze_book(spark, sf_dir)
    target = silver.silver_levels(b.where(F.col("ingest_time") < _ts(FIRST_RUN_END)))
    source = silver.silver_levels(b.where(F.col("ingest_time") >= _ts(BOOK_SECOND_START)))
    return upsert.upsert(target, source, ["product_id", "side", "price"], delete_where=F.col("size") == 0)


@query("levels_reset_on_snapshot")
def q_levels_reset_on_snapshot(spark, sf_dir):
    """Latest levels without those older than their product's newest snapshot."""
    return silver.silver_levels(bronze_book(spark, sf_dir), reset_on_snapshot=True)


@query("top_of_book")
def q_top_of_book(spark, sf_dir):
    return gold.top_of_book(book_levels(spark, sf_dir))


@query("ladder")
def q_ladder(spark, sf_dir):
    return serve.ladder(book_levels(spark, sf_dir), depth=10)


@query("ladder_spread")
def q_ladder_spread(spark, sf_dir):
    return serve.ladder_spread(serve.ladder(book_levels(spark, sf_dir), depth=10))


# ---- the rough feeds: what a live feed sends ------------------------------

def rough_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = fx.rough_book_feed(fx.events(spark, sf_dir))
    return bronze.parse_orderbook(feed, ingest_time="ingest_time", keep=["msg_offset"])


def rough_trades(spark: SparkSession, sf_dir: str, corrected: bool = False) -> DataFrame:
    feed = fx.rough_trade_feed(fx.events(spark, sf_dir), corrected)
    return bronze.parse_trades(feed, ingest_time="ingest_time", keep=["msg_offset"], time_type=NTZ)


@query("rough_envelope_parse")
def q_rough_envelope_parse(spark, sf_dir):
    """Binary messages with their raw text kept."""
    return rough_book(spark, sf_dir)


@query("rough_trade_parse")
def q_rough_trade_parse(spark, sf_dir):
    return rough_trades(spark, sf_dir)


@query("rough_trades_clean")
def q_rough_trades_clean(spark, sf_dir):
    """Required fields, and re-deliveries within one ingest time decided by their sequence."""
    return silver.clean_trades(rough_trades(spark, sf_dir))


@query("rough_bars")
def q_rough_bars(spark, sf_dir):
    """Bars with zero volume: no vwap."""
    return _round_vwap(gold.ohlcv(silver.clean_trades(rough_trades(spark, sf_dir)), "1 minute"))


@query("rough_levels_flatten")
def q_rough_levels_flatten(spark, sf_dir):
    return silver.flatten_levels(rough_book(spark, sf_dir))


@query("rough_levels_latest")
def q_rough_levels_latest(spark, sf_dir):
    return silver.silver_levels(rough_book(spark, sf_dir))


@query("rough_levels_incremental")
def q_rough_levels_incremental(spark, sf_dir):
    """The second run's bound: ingest times against the first run's exchange times."""
    b = rough_book(spark, sf_dir)
    first = silver.silver_levels(b.where(F.col("ingest_time") < _ts(FIRST_RUN_END)))
    return silver.silver_levels(b, target=first)


@query("rough_levels_ingest_bound")
def q_rough_levels_ingest_bound(spark, sf_dir):
    """The same with ingest times on both sides."""
    b = rough_book(spark, sf_dir)
    before = b.where(F.col("ingest_time") < _ts(FIRST_RUN_END))
    first = silver.silver_levels(before, watermark_col="ingest_time")
    return silver.silver_levels(b, target=first, watermark_col="ingest_time")


@query("rough_levels_reset")
def q_rough_levels_reset(spark, sf_dir):
    """Levels of messages that arrived since their product's newest snapshot; exchange times run apart
    from ingest times, and messages of one minute share an ingest time."""
    return silver.silver_levels(rough_book(spark, sf_dir), reset_on_snapshot=True)


@query("rough_levels_reset_envelope")
def q_rough_levels_reset_envelope(spark, sf_dir):
    """The same where a snapshot's levels carry its own time."""
    return silver.silver_levels(rough_book(spark, sf_dir), snapshot_time="envelope", reset_on_snapshot=True)


@query("rough_top_of_book")
def q_rough_top_of_book(spark, sf_dir):
    return gold.top_of_book(silver.silver_levels(rough_book(spark, sf_dir)))


def _lake_runs(spark: SparkSession, sf_dir: str) -> Lake:
    """Two layer runs over a lake: the messages before ``FIRST_RUN_END``, then the others with
    corrections that move earlier trades to another day."""
    lake = Lake(_scratch(spark, "lake"))
    feeds = [
        (rough_book(spark, sf_dir), lake.bronze_orderbook),
        (rough_trades(spark, sf_dir, corrected=True), lake.bronze_trades),
    ]
    for first in (True, False):
        for feed, path in feeds:
            part = feed.where((F.col("ingest_time") < _ts(FIRST_RUN_END)) == F.lit(first))
            for c in {"time", "ingest_time"} & {f.name for f in part.schema if f.dataType == NTZ}:
                part = part.withColumn(c, F.col(c).cast("timestamp"))
            write_day_partitioned(part, path, "ingest_time", mode="append")
        run_all(spark, lake)
    return lake


@query("pipeline_silver_trades")
def q_pipeline_silver_trades(spark, sf_dir):
    t = scan(spark, _lake_runs(spark, sf_dir).silver_trades)
    return t.select("trade_id", "sequence", "product_id", "price", "size", F.col("time").cast(NTZ).alias("time"))


@query("pipeline_silver_levels")
def q_pipeline_silver_levels(spark, sf_dir):
    levels = scan(spark, _lake_runs(spark, sf_dir).silver_levels)
    return levels.select("product_id", "side", "price", "size", F.col("event_time").cast(NTZ).alias("event_time"), "sequence")


@query("pipeline_gold")
def q_pipeline_gold(spark, sf_dir):
    """Bars of the touched days after the second run: equal to those of all of silver."""
    bars = scan(spark, _lake_runs(spark, sf_dir).gold_ohlcv).drop("bucket_date")
    return _round_vwap(bars.withColumn("bucket", F.col("bucket").cast(NTZ)))


@query("recent_trades_product")
def q_recent_trades_product(spark, sf_dir):
    t = trades(spark, sf_dir)
    since = lookback(t.select(F.max("time")).scalar(), serve.bars_lookback(60, 100))
    return serve.recent_trades(t, since, n=30, product_id="purchase")


@query("ticker_24h_product")
def q_ticker_24h_product(spark, sf_dir):
    t = trades(spark, sf_dir)
    return serve.ticker_24h(gold.ohlcv(t, "1 minute"), serve.latest_bucket(t, 60), product_id="purchase")


@query("ladder_product")
def q_ladder_product(spark, sf_dir):
    return serve.ladder(book_levels(spark, sf_dir), depth=10, product_id="P2")


# ---- feed quality and routing ------------------------------------------

@query("sequence_gaps")
def q_sequence_gaps(spark, sf_dir):
    return quality.sequence_gaps(
        trades(spark, sf_dir), key="product_id", seq="sequence", order=["time", "trade_id"]
    )


@query("sequence_gaps_by_session")
def q_sequence_gaps_by_session(spark, sf_dir):
    env = bronze_book(spark, sf_dir).select("type", "product_id", "sequence", "ingest_time", "msg_offset")
    return quality.sequence_gaps(
        env, key="product_id", seq="sequence", order=["ingest_time", "msg_offset"], reset=F.col("type") == "snapshot"
    )


@query("stream_sequence_gaps")
def q_stream_sequence_gaps(spark, sf_dir):
    """Gaps by session found while the messages pass; the stream is stopped and resumed from its
    checkpoint, so sequences before and after the stop meet in the state."""
    root = _scratch(spark, "stream_gaps")
    env = bronze_book(spark, sf_dir).select("type", "product_id", "sequence", "ingest_time", "msg_offset")
    for first in (True, False):
        part = env.where((F.col("ingest_time") < _ts(FIRST_RUN_END)) == F.lit(first))
        part.write.mode("append").parquet(f"{root}/feed")
        found = stream_sequence_gaps(
            spark.readStream.schema(env.schema).parquet(f"{root}/feed"),
            order=["ingest_time", "msg_offset"], reset=F.col("type") == "snapshot",
        )
        start_append(found, f"{root}/checkpoint", path=f"{root}/gaps", available_now=True).awaitTermination()
    return spark.read.parquet(f"{root}/gaps")


@query("session_numbers")
def q_session_numbers(spark, sf_dir):
    """Every order-book message with its connection's number, by product."""
    env = bronze_book(spark, sf_dir).select("type", "product_id", "ingest_time", "msg_offset")
    return quality.session_ids(
        env, F.col("type") == "snapshot", order=["ingest_time", "msg_offset"], key="product_id"
    )


@query("sequence_gaps_backfill")
def q_sequence_gaps_backfill(spark, sf_dir):
    """Gaps when a backfill gave all messages one ingest time: only the offset orders them."""
    t = trades(spark, sf_dir).withColumn("ingest_time", F.date_trunc("year", F.col("ingest_time")).cast("timestamp_ntz"))
    return quality.sequence_gaps(t, key="product_id", seq="sequence", order=["ingest_time", "trade_id"])


@query("feed_sequence_gaps")
def q_feed_sequence_gaps(spark, sf_dir):
    """The feed bridge's check: heartbeat and book messages, reset on every reconnect
    (a ``subscriptions`` confirmation starts a new connection for all products)."""
    feed = fx.mixed_feed(fx.events(spark, sf_dir))
    env = bronze.parse_orderbook(feed, ingest_time="ingest_time", keep=["msg_offset"]).select(
        "type", "product_id", "sequence", "ingest_time", "msg_offset"
    )
    checked = F.col("type").isin("heartbeat", "snapshot", "l2update")
    return quality.sequence_gaps(
        env.withColumn("sequence", F.when(checked, F.col("sequence"))), key="product_id", seq="sequence",
        order=["ingest_time", "msg_offset"], reset_all=F.col("type") == "subscriptions",
    )


@query("feed_routing")
def q_feed_routing(spark, sf_dir):
    feed = fx.mixed_feed(fx.events(spark, sf_dir))
    env = bronze.parse_orderbook(feed, ingest_time="ingest_time", keep=["msg_offset"])
    return env.select("msg_offset", "type", bronze.route_label("type").alias("route"))


@query("feed_split")
def q_feed_split(spark, sf_dir):
    feed = fx.mixed_feed(fx.events(spark, sf_dir))
    book, trade = bronze.route_feed(feed)
    return (
        book.select("msg_offset", F.lit("orderbook").alias("route"))
        .unionByName(trade.select("msg_offset", F.lit("trades").alias("route")))
    )


@query("message_counts")
def q_message_counts(spark, sf_dir):
    feed = fx.mixed_feed(fx.events(spark, sf_dir))
    env = bronze.parse_orderbook(feed, ingest_time="ingest_time")
    return quality.message_counts(env, "type")


@query("publish_records")
def q_publish_records(spark, sf_dir):
    recs = publish_records(trades(spark, sf_dir), key="product_id")
    parsed = F.from_json(F.col("value"), TRADE_RECORD_DDL, JSON_OPTIONS)
    return recs.select(
        "key",
        parsed["trade_id"].alias("trade_id"),
        parsed["price"].alias("price"),
        parsed["size"].alias("size"),
        parsed["side"].alias("side"),
        parsed["time"].alias("time"),
    )


# ---- streaming ingest and table round trips (write under the checkpoint dir) ----

def _streamed(spark: SparkSession, feed: DataFrame, parse) -> DataFrame:
    """A feed written as files, then ingested by a stream into day-partitioned bronze."""
    root = _scratch(spark, "stream")
    write_feed_files(feed, f"{root}/feed")
    start_append(
        parse(file_stream(spark, f"{root}/feed")), checkpoint=f"{root}/checkpoint", path=f"{root}/bronze",
        partition_by="ingest_time_date", available_now=True,
    ).awaitTermination()
    return spark.read.parquet(f"{root}/bronze")


@query("stream_bronze_trades")
def q_stream_bronze_trades(spark, sf_dir):
    b = _streamed(spark, fx.trade_feed(fx.events(spark, sf_dir)), streaming.bronze_trades)
    return b.select(
        "trade_id", "sequence", "product_id", "price", "size", "side",
        F.col("time").cast("timestamp_ntz").alias("time"),
    )


@query("stream_bronze_orderbook")
def q_stream_bronze_orderbook(spark, sf_dir):
    b = _streamed(spark, fx.book_feed(fx.events(spark, sf_dir)), streaming.bronze_orderbook)
    return b.select("type", "product_id", "time", "sequence")


@query("stream_bronze_resumed")
def q_stream_bronze_resumed(spark, sf_dir):
    """A stream that stops and starts again on its checkpoint takes every message once."""
    root = _scratch(spark, "resumed")
    feed = fx.trade_feed(fx.events(spark, sf_dir))
    for first in (True, False):
        part = feed.where((F.col("ingest_time") < _ts(FIRST_RUN_END)) == F.lit(first))
        write_feed_files(part, f"{root}/feed", mode="append")
        start_append(
            streaming.bronze_trades(file_stream(spark, f"{root}/feed")), checkpoint=f"{root}/checkpoint",
            path=f"{root}/bronze", partition_by="ingest_time_date", available_now=True,
        ).awaitTermination()
    return spark.read.parquet(f"{root}/bronze").select("trade_id", "product_id", "price")


@query("day_partition_roundtrip")
def q_day_partition_roundtrip(spark, sf_dir):
    path = _scratch(spark, "day_partition") + "/trades"
    write_day_partitioned(trades(spark, sf_dir), path, "time", mode="overwrite")
    return spark.read.parquet(path)


@query("full_refresh_roundtrip")
def q_full_refresh_roundtrip(spark, sf_dir):
    path = _scratch(spark, "full_refresh") + "/gold_ohlcv_1min"
    t = trades(spark, sf_dir)
    full_refresh(gold.ohlcv(t.where(F.col("time") < _ts(FIRST_RUN_END)), "1 minute"), path=path)
    full_refresh(gold.ohlcv(t, "1 minute"), path=path)  # the rebuild replaces the first table
    return _round_vwap(spark.read.parquet(path))
