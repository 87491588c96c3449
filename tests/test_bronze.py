import json

from pyspark.sql import functions as F

from tapehouse.operators import bronze
from tapehouse.operators.quality import message_counts


def feed(spark, *msgs):
    vals = [(m if isinstance(m, str) else json.dumps(m), i) for i, m in enumerate(msgs)]
    return spark.createDataFrame(vals, "value string, msg_offset long")


def test_malformed_orderbook_keeps_payload(spark):
    df = bronze.parse_orderbook(feed(spark, "nope"))
    r = df.collect()[0]
    assert r["type"] is None and r["product_id"] is None and r["payload"] == "nope"
    assert r["ingest_time"] is not None


def test_envelope_fields(spark):
    m = {"type": "l2update", "product_id": "ETH-USD", "time": "2024-01-01T00:00:01.000000Z",
         "sequence": 9, "changes": [["buy", "100.0", "0"]], "extra": 1}
    r = bronze.parse_orderbook(feed(spark, m), keep=["msg_offset"]).collect()[0]
    assert (r["type"], r["product_id"], r["time"], r["sequence"], r["msg_offset"]) == (
        "l2update", "ETH-USD", "2024-01-01T00:00:01.000000Z", 9, 0)
    assert json.loads(r["payload"])["extra"] == 1  # unknown fields kept in the raw text


def test_trade_parse_bad_number_and_time_are_null(spark):
    m = {"type": "match", "trade_id": 7, "sequence": 12, "product_id": "ETH-USD",
         "price": "abc", "size": "0.5", "side": "buy", "time": "nope"}
    r = bronze.parse_trades(feed(spark, m)).collect()[0]
    assert r["price"] is None and r["time"] is None and r["size"] == 0.5 and r["trade_id"] == 7


def test_trade_parse_values(spark):
    m = {"type": "match", "trade_id": 7, "sequence": 12, "product_id": "ETH-USD",
         "price": "100.25", "size": "0.5", "side": "buy", "time": "2024-01-01T00:00:02.000000Z"}
    r = bronze.parse_trades(feed(spark, m)).collect()[0]
    assert r["price"] == 100.25 and str(r["time"]) == "2024-01-01 00:00:02"


def test_binary_value_is_cast(spark):
    df = spark.createDataFrame([(bytearray(b'{"type":"heartbeat","product_id":"X"}'),)], "value binary")
    r = bronze.parse_orderbook(df).collect()[0]
    assert r["type"] == "heartbeat"


def test_route_feed_and_labels(spark):
    msgs = [{"type": t, "product_id": "P"} for t in
            ["snapshot", "l2update", "match", "last_match", "heartbeat", "subscriptions", "error"]]
    f = feed(spark, *msgs, "nope")
    book, trades = bronze.route_feed(f)
    assert book.count() == 2 and trades.count() == 2
    env = bronze.parse_orderbook(f)
    labels = {r["type"]: r["route"] for r in env.select("type", bronze.route_label("type").alias("route")).collect()}
    assert labels["snapshot"] == "orderbook" and labels["last_match"] == "trades"
    assert labels["heartbeat"] is None and labels[None] is None
    counts = {r["type"]: r["messages"] for r in message_counts(env).collect()}
    assert counts["match"] == 1 and counts[None] == 1 and sum(counts.values()) == 8


def test_parse_once_filters_do_not_reparse(spark):
    m = {"type": "match", "trade_id": 1, "product_id": "A", "price": "1", "size": "1",
         "side": "buy", "time": "2024-01-01T00:00:00Z"}
    b = bronze.parse_trades(feed(spark, m)).where(F.col("trade_id").isNotNull())
    plan = b._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
