"""Market-data views derived by Spark from the driver's ``events`` table.

events(event_id, ts, user_id, event_type, value, props) is read whole and
mapped row by row onto feed messages, so every view grows with the table:

- trades: trade_id = sequence = event_id, product = event_type,
  price = value, size = event_id % 10 + 1, side from the parity of user_id,
  time = ingest_time = ts.
- trade feed: the same trades rendered as JSON ``match`` messages (numbers
  as strings, ISO time), optionally with re-deliveries of every trade of
  the first six minutes of each hour one hour later (a reconnect replay).
- book feed: one order-book message per event: product ``P<user_id % 5>``,
  every 50th event a snapshot (one level in ``bids`` or ``asks``), the rest
  ``l2update`` with one change; side buy for click/view, price
  round(value), size event_id % 4 (0 = level removed).
- mixed feed: every message kind (snapshot, l2update, match, last_match,
  heartbeat, subscriptions, error) for routing and counting.

- rough book and rough trade feeds: the same events as a live feed sends them,
  as binary text: several levels a message, empty, missing and short arrays,
  broken prices and times, missing products and ids, an exchange clock that
  differs from the ingest clock, tied ingest times, re-deliveries, zero sizes.

The same mapping rules are written as SQL in ``tapehouse.plans.oracle``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapehouse.functions import iso_utc

# Fixed values of the fixture mapping (shared with the oracle SQL text).
SNAPSHOT_EVERY = 50
PRODUCTS_IN_BOOK = 5
MIXED_TYPE_SQL = (
    "CASE WHEN event_type = 'error' THEN 'error' "
    "WHEN event_type = 'signup' THEN 'heartbeat' "
    "WHEN event_type = 'purchase' THEN "
    "(CASE WHEN event_id % 10 = 0 THEN 'last_match' ELSE 'match' END) "
    "WHEN event_id % 50 = 0 THEN 'snapshot' "
    "WHEN event_id % 97 = 0 THEN 'subscriptions' "
    "ELSE 'l2update' END"
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def trades_view(ev: DataFrame) -> DataFrame:
    """Silver-shaped trades straight from events (no JSON round trip)."""
    return ev.select(
        F.col("event_id").alias("trade_id"),
        F.col("event_id").alias("sequence"),
        F.col("event_type").alias("product_id"),
        F.col("value").alias("price"),
        (F.col("event_id") % 10 + 1).cast("double").alias("size"),
        F.when(F.col("user_id") % 2 == 0, F.lit("buy")).otherwise(F.lit("sell")).alias("side"),
        F.col("ts").alias("time"),
        F.col("ts").alias("ingest_time"),
    )


def _trade_json(t: DataFrame, price=None, time=None) -> DataFrame:
    body = F.to_json(
        F.struct(
            F.lit("match").alias("type"),
            F.col("trade_id"),
            F.col("sequence"),
            F.col("product_id"),
            (price if price is not None else F.col("price").cast("string")).alias("price"),
            F.col("size").cast("string").alias("size"),
            F.col("side"),
            (time if time is not None else iso_utc("time")).alias("time"),
        )
    )
    return t.select(body.alias("value"), F.col("trade_id").alias("msg_offset"), "ingest_time")


def trade_feed(ev: DataFrame, redeliver: bool = False) -> DataFrame:
    """Raw trade messages (value, msg_offset, ingest_time)."""
    t = trades_view(ev)
    feed = _trade_json(t)
    if redeliver:
        again = t.where(F.minute("time") < 6).withColumn(
            "ingest_time", F.col("ingest_time") + F.expr("INTERVAL 1 HOUR")
        )
        feed = feed.unionByName(_trade_json(again))
    return feed


def malformed_trade_feed(ev: DataFrame) -> DataFrame:
    """Trade messages with broken prices (event_id % 13 = 0), broken times
    (% 17 = 0) and wholly malformed JSON (% 19 = 0)."""
    t = trades_view(ev)
    eid = F.col("trade_id")
    price = F.when(eid % 13 == 0, F.lit("abc")).otherwise(F.col("price").cast("string"))
    time = F.when(eid % 17 == 0, F.lit("nope")).otherwise(iso_utc("time"))
    feed = _trade_json(t, price=price, time=time)
    return feed.withColumn(
        "value", F.when(F.col("msg_offset") % 19 == 0, F.lit("nope")).otherwise(F.col("value"))
    )


def book_feed(ev: DataFrame) -> DataFrame:
    """Raw order-book messages (value, msg_offset, ingest_time)."""
    eid = F.col("event_id")
    snap = eid % SNAPSHOT_EVERY == 0
    product = F.concat(F.lit("P"), (F.col("user_id") % PRODUCTS_IN_BOOK).cast("string"))
    side = F.when(F.col("event_type").isin("click", "view"), F.lit("buy")).otherwise(F.lit("sell"))
    price = F.round("value", 0).cast("string")
    size = (eid % 4).cast("double").cast("string")
    pair = F.array(F.array(price, size))
    snapshot_msg = F.to_json(
        F.struct(
            F.lit("snapshot").alias("type"),
            product.alias("product_id"),
            F.when(side == "buy", pair).alias("bids"),
            F.when(side == "sell", pair).alias("asks"),
        )
    )
    update_msg = F.to_json(
        F.struct(
            F.lit("l2update").alias("type"),
            product.alias("product_id"),
            iso_utc("ts").alias("time"),
            eid.alias("sequence"),
            F.array(F.array(side, price, size)).alias("changes"),
        )
    )
    return ev.select(
        F.when(snap, snapshot_msg).otherwise(update_msg).alias("value"),
        eid.alias("msg_offset"),
        F.col("ts").alias("ingest_time"),
    )


def mixed_feed(ev: DataFrame) -> DataFrame:
    """Every message kind of the feed, one per event (value, msg_offset, ingest_time)."""
    mtype = F.expr(MIXED_TYPE_SQL)
    product = F.col("event_type")
    msg = F.to_json(
        F.struct(
            mtype.alias("type"),
            F.when(mtype != "subscriptions", product).alias("product_id"),
            F.col("event_id").alias("sequence"),
            iso_utc("ts").alias("time"),
        )
    )
    return ev.select(
        msg.alias("value"), F.col("event_id").alias("msg_offset"), F.col("ts").alias("ingest_time")
    )


def _text(*parts) -> Column:
    """Concatenated JSON text; plain strings are literals."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _rough_clocks() -> tuple[Column, Column]:
    """(ingest time: cut to the minute, message time as text: up to two minutes ahead, broken for every 17th)."""
    eid = F.col("event_id")
    ingest = (F.date_trunc("minute", "ts") + F.expr("INTERVAL 1 MINUTE")).cast("timestamp_ntz")
    moved = F.col("ts") + F.expr("make_dt_interval(0, 0, CAST(event_id % 3 AS INT))")
    return ingest, F.when(eid % 17 == 0, F.lit("nope")).otherwise(iso_utc(moved))


def rough_book_feed(ev: DataFrame) -> DataFrame:
    """Raw order-book messages as binary (value, msg_offset, ingest_time), see the module's text."""
    eid, user = F.col("event_id"), F.col("user_id")
    ingest, time = _rough_clocks()
    product = F.when(eid % 43 == 0, F.lit("null")).otherwise(_text('"P', user % 5, '"'))
    base = F.round("value", 0).cast("bigint")

    def entries(n, side):
        def one(i):
            price = F.when((eid + i) % 37 == 0, F.lit("abc")).otherwise((base + i).cast("string"))
            size = F.when((eid + i) % 31 == 0, F.lit("")).otherwise(_text(',"', (eid + i) % 4, '"'))
            return _text("[", side(i), '"', price, '"', size, "]")

        some = F.filter(F.array(*[F.lit(i).cast("bigint") for i in range(1, 5)]), lambda i: i <= n)
        return F.concat_ws(",", F.transform(some, one))

    def no_side(i):
        return F.lit("")

    def either(i):
        return F.when((eid + i) % 2 == 0, F.lit('"buy",')).otherwise(F.lit('"sell",'))

    snapshot = _text('{"type":"snapshot","product_id":', product, ',"time":"', time, '","bids":[',
                     entries(user % 4, no_side), '],"asks":[', entries(user % 3, no_side), "]}")
    changes = F.when(eid % 29 == 0, F.lit("")).otherwise(_text(',"changes":[', entries(eid % 5, either), "]"))
    update = _text('{"type":"l2update","product_id":', product, ',"time":"', time, '","sequence":', eid, changes, "}")
    value = F.when(eid % SNAPSHOT_EVERY == 0, snapshot).otherwise(update)
    return ev.select(value.cast("binary").alias("value"), eid.alias("msg_offset"), ingest.alias("ingest_time"))


def rough_trade_feed(ev: DataFrame, corrected: bool = False) -> DataFrame:
    """Raw trade messages as binary (value, msg_offset, ingest_time), see the module's text.

    Every fifth trade comes twice within one ingest time, the second with the
    next sequence and a price one higher. ``corrected`` adds, 40 days later,
    every eleventh trade with a time one day on.
    """
    eid = F.col("event_id")
    ingest, _ = _rough_clocks()

    def message(add: int, days: int):
        time = F.when(eid % 31 == 0, F.lit("nope")).otherwise(iso_utc(F.col("ts") + F.expr(f"INTERVAL {days} DAY")))
        return _text(
            '{"type":"match","trade_id":', F.when(eid % 23 == 0, F.lit("null")).otherwise(eid.cast("string")),
            ',"sequence":', eid + add, ',"product_id":', F.when(eid % 29 == 0, F.lit("null")).otherwise(
                _text('"', F.col("event_type"), '"')),
            ',"price":"', F.round("value", 0).cast("bigint") + add, '","size":"', eid % 2,
            '","side":"buy","time":"', time, '"}').cast("binary").alias("value")

    one = ev.select(message(0, 0), eid.alias("msg_offset"), ingest.alias("ingest_time"))
    two = ev.where(eid % 5 == 0).select(message(1, 0), eid.alias("msg_offset"), ingest.alias("ingest_time"))
    feed = one.unionByName(two)
    if corrected:
        late = (ingest + F.expr("INTERVAL 40 DAY")).alias("ingest_time")
        feed = feed.unionByName(ev.where(eid % 11 == 0).select(message(2, 1), eid.alias("msg_offset"), late))
    return feed
