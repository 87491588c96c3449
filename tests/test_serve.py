import datetime as dt

from pyspark.sql import functions as F

from tapehouse.operators import gold, serve
from tapehouse.plans.fixtures import events, trades_view

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)
BARS = ("product_id string, bucket timestamp, open double, high double, low double, close double, "
        "volume double, vwap double, trade_count long")
LVL = "product_id string, side string, price double, size double, event_time timestamp, sequence long"


def minute(i):
    return T0 + dt.timedelta(minutes=i)


def test_resample_first_last_and_weights(spark):
    bars = spark.createDataFrame(
        [("A", minute(0), 1.0, 5.0, 1.0, 2.0, 1.0, 2.0, 1), ("A", minute(59), 2.0, 9.0, 0.5, 3.0, 3.0, 4.0, 2),
         ("A", minute(60), 7.0, 7.0, 7.0, 7.0, 0.0, None, 1)], BARS)
    out = {r["bucket"]: r for r in serve.resample(bars, "1 hour").collect()}
    h0 = out[T0]
    assert (h0["open"], h0["high"], h0["low"], h0["close"], h0["volume"], h0["trade_count"]) == (1.0, 9.0, 0.5, 3.0, 4.0, 3)
    assert abs(h0["vwap"] - (2.0 * 1 + 4.0 * 3) / 4) < 1e-12
    assert out[minute(60)]["vwap"] is None  # zero volume


def test_resample_skips_null_open(spark):
    bars = spark.createDataFrame(
        [("A", minute(0), None, 5.0, 1.0, None, 1.0, 2.0, 1), ("A", minute(1), 2.0, 9.0, 0.5, 3.0, 3.0, 4.0, 2)], BARS)
    r = serve.resample(bars, "1 hour").collect()[0]
    assert r["open"] == 2.0 and r["close"] == 3.0


def test_resample_volume_preserved(spark):
    t = trades_view(events(spark, "/root/testdata/sf0.001"))
    bars = gold.ohlcv(t, "1 minute")
    two = serve.resample(bars, "2 hours")
    assert two.agg(F.sum("volume")).first()[0] == bars.agg(F.sum("volume")).first()[0]
    assert two.agg(F.sum("trade_count")).first()[0] == t.count()


def test_last_bars_and_direction(spark):
    bars = spark.createDataFrame(
        [("A", minute(i), 1.0, 1.0, 1.0, 1.0 + (i % 2) - 0.5, 1.0, 1.0, 1) for i in range(5)], BARS)
    last = serve.last_bars(bars, 3)
    assert sorted(r["bucket"] for r in last.collect()) == [minute(2), minute(3), minute(4)]
    d = {r["bucket"]: r["direction"] for r in serve.with_direction(bars).collect()}
    assert d[minute(0)] == "down" and d[minute(1)] == "up"


def test_ticker_zero_first_close(spark):
    bars = spark.createDataFrame(
        [("A", minute(0), 0.0, 1.0, 0.0, 0.0, 1.0, 1.0, 1), ("A", minute(10), 1.0, 2.0, 1.0, 2.0, 2.0, 1.5, 1),
         ("B", minute(0), 4.0, 4.0, 4.0, 4.0, 1.0, 4.0, 1), ("B", minute(5), 5.0, 6.0, 5.0, 5.0, 1.0, 5.0, 1),
         ("B", minute(-2000), 9.0, 99.0, 9.0, 9.0, 1.0, 9.0, 1)], BARS)
    out = {r["product_id"]: r for r in serve.ticker_24h(bars, minute(10)).collect()}
    assert out["A"]["change_pct"] == 0.0 and out["A"]["last_price"] == 2.0
    assert abs(out["B"]["change_pct"] - 25.0) < 1e-12 and out["B"]["high_24h"] == 6.0  # old bar excluded
    assert out["A"]["volume_24h"] == 3.0


def test_ladder_depth_and_order(spark):
    lv = spark.createDataFrame(
        [("A", "buy", float(p), 1.0, T0, 1) for p in range(1, 8)]
        + [("A", "sell", float(p), 1.0, T0, 1) for p in range(10, 17)]
        + [("A", "buy", 100.0, 0.0, T0, 1)], LVL)
    lad = serve.ladder(lv, depth=3)
    bids = [r["price"] for r in lad.where("side = 'buy'").orderBy("level").collect()]
    asks = [r["price"] for r in lad.where("side = 'sell'").orderBy("level").collect()]
    assert bids == [7.0, 6.0, 5.0] and asks == [10.0, 11.0, 12.0]
    assert serve.ladder_spread(lad).collect()[0]["spread"] == 3.0


def test_ladder_spread_needs_both_sides(spark):
    lv = spark.createDataFrame([("A", "buy", 1.0, 1.0, T0, 1)], LVL)
    assert serve.ladder_spread(serve.ladder(lv)).collect()[0]["spread"] is None


def test_recent_trades_tape(spark):
    t = trades_view(events(spark, "/root/testdata/sf0.001"))
    asof = t.agg(F.max("time")).first()[0]
    tape = serve.recent_trades(t, asof - dt.timedelta(days=2), n=30, product_id="click")
    got = tape.collect()
    assert 0 < len(got) <= 30 and {r["product_id"] for r in got} == {"click"}
    assert tape.columns == ["product_id", "time", "side", "price", "size", "trade_id"]
    newest = t.where("product_id = 'click'").orderBy(F.desc("time"), F.desc("trade_id")).limit(len(got))
    assert sorted(r["trade_id"] for r in got) == sorted(r["trade_id"] for r in newest.collect())


def test_empty_inputs(spark):
    bars = spark.createDataFrame([], BARS)
    assert serve.resample(bars, "1 hour").count() == 0
    assert serve.ticker_24h(bars, T0).count() == 0
    assert serve.ladder(spark.createDataFrame([], LVL)).count() == 0


def test_latest_bucket_equals_max_bar(spark):
    t = trades_view(events(spark, "/root/testdata/sf0.001"))
    for secs, interval in ((60, "1 minute"), (3600, "1 hour")):
        want = gold.ohlcv(t, interval).agg(F.max("bucket")).first()[0]
        got = t.select(serve.latest_bucket(t, secs).alias("b")).first()["b"]
        assert got == want
    ltz = t.withColumn("time", F.col("time").cast("timestamp"))
    assert ltz.select(serve.latest_bucket(ltz, 60).alias("b")).schema["b"].dataType.simpleString() == "timestamp"


def test_chart_bars_product_and_lookback(spark):
    t = trades_view(events(spark, "/root/testdata/sf0.001"))
    bars = gold.ohlcv(t, "1 minute")
    asof = bars.agg(F.max("bucket")).first()[0]
    out = serve.chart_bars(bars, asof, rule="1 hour", minutes_per_bar=60, n=20, product_id="view")
    got = out.collect()
    assert 0 < len(got) <= 20 and {r["product_id"] for r in got} == {"view"}
    assert {r["direction"] for r in got} <= {"up", "down"}
    cutoff = asof - dt.timedelta(minutes=60 * 20 * 1.2)
    assert min(r["bucket"] for r in got) >= cutoff.replace(minute=0, second=0, microsecond=0)
