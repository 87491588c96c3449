import datetime as dt
import json

from pyspark.sql import functions as F

from tapehouse.operators import bronze, silver

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def book(spark, *items):
    """items: (message dict or str, ingest datetime)."""
    data = [(m if isinstance(m, str) else json.dumps(m), ts) for m, ts in items]
    raw = spark.createDataFrame(data, "value string, ingest_time timestamp")
    return bronze.parse_orderbook(raw, ingest_time="ingest_time")


def trades(spark, *items):
    data = [(json.dumps(m), ts) for m, ts in items]
    raw = spark.createDataFrame(data, "value string, ingest_time timestamp")
    return bronze.parse_trades(raw, ingest_time="ingest_time")


def trade(i, seq=1, time="2024-01-01T00:00:00Z", product="A", price="1"):
    return {"type": "match", "trade_id": i, "sequence": seq, "product_id": product,
            "price": price, "size": "1", "side": "buy", "time": time}


def test_flatten_snapshot_and_update(spark):
    b = book(spark,
             ({"type": "snapshot", "product_id": "ETH", "bids": [["100.0", "2.5"], ["99.5", "1"]],
               "asks": [["100.5", "3"]]}, T0),
             ({"type": "l2update", "product_id": "ETH", "time": "2024-01-01T00:00:01Z",
               "sequence": 4, "changes": [["buy", "100.0", "0"], ["sell", "101"]]}, T0))
    got = sorted((r["side"], r["price"], r["size"], r["sequence"]) for r in silver.flatten_levels(b).collect())
    assert got == sorted([("buy", 100.0, 2.5, None), ("buy", 99.5, 1.0, None), ("sell", 100.5, 3.0, None),
                          ("buy", 100.0, 0.0, 4), ("sell", 101.0, None, 4)])


def test_empty_arrays_and_malformed_give_no_levels(spark):
    b = book(spark, ({"type": "snapshot", "product_id": "X", "bids": [], "asks": []}, T0),
             ("nope", T0), ({"type": "l2update", "product_id": "X", "changes": []}, T0))
    assert silver.flatten_levels(b).count() == 0


def test_snapshot_with_only_bids(spark):
    b = book(spark, ({"type": "snapshot", "product_id": "X", "bids": [["1", "1"]]}, T0))
    assert silver.flatten_levels(b).count() == 1


def test_update_time_fallback_to_ingest(spark):
    b = book(spark, ({"type": "l2update", "product_id": "X", "time": "nope",
                      "changes": [["buy", "1", "1"]]}, T0))
    assert silver.flatten_levels(b).collect()[0]["event_time"] == T0


def test_equal_event_time_update_beats_snapshot(spark):
    b = book(spark,
             ({"type": "snapshot", "product_id": "X", "bids": [["1", "5"]]}, T0),
             ({"type": "l2update", "product_id": "X", "time": "2024-01-01T00:00:00Z", "sequence": 3,
               "changes": [["buy", "1", "7"]]}, T0))
    r = silver.silver_levels(b).collect()
    assert len(r) == 1 and r[0]["size"] == 7.0 and r[0]["sequence"] == 3


def test_snapshot_time_option(spark):
    # Snapshot ingested at T0+10s, update with exchange time T0+5s (after the
    # snapshot was taken, but an earlier clock value).
    later = T0 + dt.timedelta(seconds=10)
    items = [({"type": "snapshot", "product_id": "X", "time": "2024-01-01T00:00:01Z",
               "bids": [["1", "5"]]}, later),
             ({"type": "l2update", "product_id": "X", "time": "2024-01-01T00:00:05Z", "sequence": 3,
               "changes": [["buy", "1", "7"]]}, later)]
    faithful = silver.silver_levels(book(spark, *items)).collect()[0]
    assert faithful["size"] == 5.0  # snapshot stamped with ingest time wins
    envelope = silver.silver_levels(book(spark, *items), snapshot_time="envelope").collect()[0]
    assert envelope["size"] == 7.0


def test_incremental_since_levels_uses_target_event_time(spark):
    b = book(spark,
             ({"type": "l2update", "product_id": "X", "time": "2024-01-01T00:00:00Z", "sequence": 1,
               "changes": [["buy", "1", "1"]]}, T0),
             ({"type": "l2update", "product_id": "X", "time": "2024-01-01T00:01:00Z", "sequence": 2,
               "changes": [["buy", "2", "1"]]}, T0 + dt.timedelta(minutes=1)))
    first = silver.silver_levels(b.where(F.col("sequence") == 1))
    second = silver.silver_levels(b, target=first)
    assert [r["price"] for r in second.collect()] == [2.0]
    assert silver.silver_levels(b, target=first, inline_bound=True).count() == 1


def test_clean_trades_drops_missing_required_fields(spark):
    bad = [trade(None), {**trade(2), "product_id": None}, {**trade(3), "time": None}, trade(4)]
    t = trades(spark, *[(m, T0) for m in bad])
    assert [r["trade_id"] for r in silver.clean_trades(t).collect()] == [4]


def test_redelivered_trade_keeps_latest_ingest(spark):
    t = trades(spark, (trade(1, price="1"), T0), (trade(1, price="2"), T0 + dt.timedelta(hours=1)),
               (trade(2), T0))
    out = {r["trade_id"]: r for r in silver.clean_trades(t).collect()}
    assert len(out) == 2 and out[1]["price"] == 2.0 and "raw_payload" not in out[1]


def test_tied_ingest_time_is_deterministic(spark):
    t = trades(spark, (trade(1, seq=1, price="1"), T0), (trade(1, seq=2, price="2"), T0))
    assert silver.clean_trades(t).collect()[0]["price"] == 2.0  # higher sequence wins


def test_second_run_without_new_rows_adds_nothing(spark):
    t = trades(spark, (trade(1), T0), (trade(2), T0 + dt.timedelta(seconds=1)))
    first = silver.clean_trades(t)
    assert silver.clean_trades(t, target=first).count() == 0
    assert silver.clean_trades(t, target=None).count() == 2


def test_empty_input_keeps_schema(spark):
    t = trades(spark, (trade(1), T0)).where("false")
    out = silver.clean_trades(t)
    assert out.count() == 0 and out.columns[:3] == ["trade_id", "sequence", "product_id"]


def test_level_watermark_clock_options(spark):
    # exchange clock one hour ahead of the ingest clock
    first = [({"type": "l2update", "product_id": "X", "time": "2024-01-01T01:00:00Z", "sequence": 1,
               "changes": [["buy", "1", "1"]]}, T0)]
    later = first + [({"type": "l2update", "product_id": "X", "time": "2024-01-01T01:10:00Z", "sequence": 2,
                       "changes": [["buy", "2", "1"]]}, T0 + dt.timedelta(minutes=10))]
    # faithful: ingest_time (00:10) is not after max(event_time) (01:00): the new row is skipped
    tgt = silver.silver_levels(book(spark, *first))
    assert silver.silver_levels(book(spark, *later), target=tgt).count() == 0
    # ingest-clock watermark: the new row is read
    tgt2 = silver.silver_levels(book(spark, *first), watermark_col="ingest_time")
    assert "ingest_time" in tgt2.columns
    got = silver.silver_levels(book(spark, *later), target=tgt2, watermark_col="ingest_time")
    assert [r["price"] for r in got.collect()] == [2.0]


def _message(kind, product, time, **body):
    return {"type": kind, "product_id": product, "time": time, **body}


def test_reset_goes_by_arrival_not_by_exchange_time(spark):
    """Exchange times before the ingest stamp: nothing of the new book may be lost."""
    snapshot = _message("snapshot", "X", "2023-12-31T23:00:00Z", bids=[["1", "1"], ["2", "1"]])
    update = _message("l2update", "X", "2023-12-31T22:59:00Z", changes=[["buy", "3", "1"]], sequence=1)
    old = _message("l2update", "X", "2024-01-01T05:00:00Z", changes=[["buy", "9", "1"]], sequence=0)
    null = _message("l2update", None, "2024-01-01T05:00:00Z", changes=[["buy", "7", "1"]], sequence=0)
    later = T0 + dt.timedelta(minutes=1)
    for at in (T0, later):  # with the snapshot's ingest stamp and after it
        b = book(spark, (old, T0 - dt.timedelta(minutes=1)), (null, T0), (snapshot, T0), (update, at))
        for snapshot_time in ("ingest", "envelope"):
            got = silver.silver_levels(b, snapshot_time=snapshot_time, reset_on_snapshot=True)
            assert sorted(r["price"] for r in got.collect()) == [1.0, 2.0, 3.0, 7.0]


def test_reset_uses_offsets_within_one_ingest_time(spark):
    items = [
        (0, _message("l2update", "X", "2024-01-01T05:00:00Z", changes=[["buy", "9", "1"]])),
        (1, _message("snapshot", "X", "2024-01-01T00:00:00Z", bids=[["1", "1"]])),
        (2, _message("l2update", "X", "2023-12-31T00:00:00Z", changes=[["buy", "2", "1"]])),
    ]
    raw = spark.createDataFrame([(json.dumps(m), i, T0) for i, m in items], "value string, offset long, ingest_time timestamp")
    b = bronze.parse_orderbook(raw, ingest_time="ingest_time", keep=["offset"])
    assert sorted(r["price"] for r in silver.silver_levels(b, reset_on_snapshot=True).collect()) == [1.0, 2.0]
