import datetime as dt

from pyspark.sql import functions as F

from tapehouse.operators import gold, upsert

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)
LVL = "product_id string, side string, price double, size double, event_time timestamp, sequence long"


def test_upsert_replaces_and_inserts(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    src = spark.createDataFrame([(2, "B"), (3, "C")], "k long, v string")
    out = sorted(tuple(r) for r in upsert.upsert(tgt, src, ["k"]).collect())
    assert out == [(1, "a"), (2, "B"), (3, "C")]


def test_upsert_null_key_never_matches(spark):
    tgt = spark.createDataFrame([("X", "buy", None, 1.0, T0, None)], LVL)
    src = spark.createDataFrame([("X", "buy", None, 2.0, T0, None)], LVL)
    assert upsert.upsert(tgt, src, ["product_id", "side", "price"]).count() == 2


def test_upsert_late_older_row(spark):
    tgt = spark.createDataFrame([("X", "buy", 1.0, 5.0, T0 + dt.timedelta(minutes=1), 9)], LVL)
    late = spark.createDataFrame([("X", "buy", 1.0, 7.0, T0, 3)], LVL)
    keys = ["product_id", "side", "price"]
    assert upsert.upsert(tgt, late, keys).collect()[0]["size"] == 7.0  # faithful: overwrites
    guarded = upsert.upsert(tgt, late, keys, newer_by=["event_time", "sequence"]).collect()
    assert len(guarded) == 1 and guarded[0]["size"] == 5.0


def test_upsert_guarded_keeps_null_keys_and_inserts(spark):
    keys = ["product_id", "side", "price"]
    tgt = spark.createDataFrame([("X", "buy", None, 1.0, T0, 1), ("X", "buy", 1.0, 1.0, T0, 1)], LVL)
    src = spark.createDataFrame([("X", "buy", None, 2.0, T0, 2), ("X", "sell", 2.0, 1.0, T0, 2)], LVL)
    assert upsert.upsert(tgt, src, keys, newer_by=["event_time", "sequence"]).count() == 4


def test_upsert_delete_where(spark):
    tgt = spark.createDataFrame([("X", "buy", 1.0, 5.0, T0, 1)], LVL)
    src = spark.createDataFrame([("X", "buy", 1.0, 0.0, T0, 2)], LVL)
    out = upsert.upsert(tgt, src, ["product_id", "side", "price"], delete_where=F.col("size") == 0)
    assert out.count() == 0


TRD = "trade_id long, product_id string, price double, size double, time timestamp"


def test_ohlcv_ties_broken_by_trade_id(spark):
    df = spark.createDataFrame(
        [(2, "A", 10.0, 1.0, T0), (1, "A", 20.0, 1.0, T0), (3, "A", 15.0, 2.0, T0 + dt.timedelta(seconds=59)),
         (4, "A", 30.0, 1.0, T0 + dt.timedelta(seconds=60))], TRD)
    bars = {r["bucket"]: r for r in gold.ohlcv(df).collect()}
    b = bars[T0]
    assert (b["open"], b["high"], b["low"], b["close"], b["volume"], b["trade_count"]) == (20.0, 20.0, 10.0, 15.0, 4.0, 3)
    assert abs(b["vwap"] - (10 + 20 + 30) / 4) < 1e-12
    assert bars[T0 + dt.timedelta(minutes=1)]["open"] == 30.0


def test_ohlcv_zero_volume_vwap_null(spark):
    df = spark.createDataFrame([(1, "A", 10.0, 0.0, T0)], TRD)
    assert gold.ohlcv(df).collect()[0]["vwap"] is None


def test_ohlcv_keeps_ntz(spark):
    df = spark.createDataFrame([(1, "A", 10.0, 1.0, T0)], TRD).withColumn("time", F.col("time").cast("timestamp_ntz"))
    assert gold.ohlcv(df).schema["bucket"].dataType.simpleString() == "timestamp_ntz"


def test_ohlcv_invariants_on_events(spark):
    from tapehouse.plans.fixtures import events, trades_view

    t = trades_view(events(spark, "/root/testdata/sf0.001"))
    bars = gold.ohlcv(t, "1 hour")
    bad = bars.where(
        (F.col("low") > F.least("open", "close")) | (F.col("high") < F.greatest("open", "close"))
        | (F.col("vwap") < F.col("low") - 1e-9) | (F.col("vwap") > F.col("high") + 1e-9)
    )
    assert bad.count() == 0
    assert bars.agg(F.sum("trade_count")).first()[0] == t.count()


def test_top_of_book_one_sided_and_removed(spark):
    lv = spark.createDataFrame(
        [("A", "buy", 10.0, 1.0, T0, 1), ("A", "buy", 11.0, 0.0, T0, 2), ("A", "sell", 12.0, 1.0, T0, 3),
         ("B", "buy", 5.0, 1.0, T0, 1)], LVL)
    out = {r["product_id"]: r for r in gold.top_of_book(lv).collect()}
    assert (out["A"]["best_bid"], out["A"]["best_ask"], out["A"]["spread"]) == (10.0, 12.0, 2.0)
    assert out["B"]["best_ask"] is None and out["B"]["spread"] is None
