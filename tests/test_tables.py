import datetime as dt
import json

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tapehouse.operators import bronze, silver
from tapehouse.operators.quality import observe_feed
from tapehouse.plans.layers import Lake, run_silver_levels
from tapehouse.sources.tables import (
    create_namespaces,
    create_table,
    filtered_scan,
    full_refresh,
    scan,
    upsert_parquet,
    write_day_partitioned,
)

T0 = dt.datetime(2024, 1, 1)


def test_namespaces_and_ddl(spark, tmp_dir):
    create_namespaces(spark)
    for ns in ("bronze", "silver", "gold"):
        assert spark.catalog.databaseExists(ns)
    create_table(spark, "bronze.trades", location=f"{tmp_dir}/bt")
    create_table(spark, "bronze.trades", location=f"{tmp_dir}/bt")  # idempotent
    cols = [c.name for c in spark.catalog.listColumns("bronze.trades")]
    assert cols[:3] == ["trade_id", "sequence", "product_id"] and "ingest_time_date" in cols
    create_table(spark, "gold.gold_top_of_book", location=f"{tmp_dir}/tob")
    assert spark.table("gold.gold_top_of_book").count() == 0


def test_day_partition_and_filtered_scan(spark, tmp_dir):
    df = spark.createDataFrame([(1, T0), (2, T0 + dt.timedelta(days=1))], "id long, time timestamp")
    write_day_partitioned(df, f"{tmp_dir}/p", "time")
    scan = filtered_scan(spark, f"{tmp_dir}/p", "time_date = DATE'2024-01-02'", ["id"])
    assert [r["id"] for r in scan.collect()] == [2]
    assert "PartitionFilters: [isnotnull(time_date" in scan._jdf.queryExecution().executedPlan().toString()


def test_full_refresh_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a")], "k long, v string")
    full_refresh(df, path=f"{tmp_dir}/g")
    full_refresh(df.withColumn("v", F.lit("b")), path=f"{tmp_dir}/g")
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_dir}/g").collect()] == [(1, "b")]


def test_upsert_parquet_rewrites_only_touched_partitions(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    tgt = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k long, v string, part int")
    upsert_parquet(spark, path, tgt, ["k"], "part")
    src = spark.createDataFrame([(2, "B", 2), (3, "C", 2)], "k long, v string, part int")
    res = upsert_parquet(spark, path, src, ["k"], "part")
    assert res.rows == 2 and res.touched == ["part=2"]
    got = sorted((r["k"], r["v"], r["part"]) for r in scan(spark, path).collect())
    assert got == [(1, "a", 1), (2, "B", 2), (3, "C", 2)]
    empty = src.where("false")
    assert upsert_parquet(spark, path, empty, ["k"], "part").rows == 0


def _book(spark, path, items):
    data = [(json.dumps(m), ts) for m, ts in items]
    raw = spark.createDataFrame(data, "value string, ingest_time timestamp")
    bronze.parse_orderbook(raw, ingest_time="ingest_time").write.mode("append").parquet(path)


def test_reconnect_snapshot_reset(spark, tmp_dir):
    first = [({"type": "snapshot", "product_id": "X", "bids": [["1", "1"], ["2", "1"]]}, T0)]
    second = [({"type": "snapshot", "product_id": "X", "bids": [["1", "3"]]}, T0 + dt.timedelta(hours=1))]
    for reset, expect in ((False, {1.0: 3.0, 2.0: 1.0}), (True, {1.0: 3.0})):
        lake = Lake(f"{tmp_dir}/{reset}")
        _book(spark, lake.bronze_orderbook, first)
        run_silver_levels(spark, lake, reset_on_snapshot=reset)
        _book(spark, lake.bronze_orderbook, second)
        run_silver_levels(spark, lake, reset_on_snapshot=reset)
        got = {r["price"]: r["size"] for r in scan(spark, lake.silver_levels).collect()}
        assert got == expect


def test_observe_feed_counts(spark):
    msgs = [{"type": "snapshot"}, {"type": "match"}, {"type": "heartbeat"}]
    raw = spark.createDataFrame([(json.dumps(m),) for m in msgs] + [("nope",)], "value string")
    obs = Observation("feed")
    env = bronze.parse_orderbook(raw)
    env.observe(obs, F.count(F.lit(1)).alias("n")).collect()
    assert obs.get["n"] == 4
    out = observe_feed(env, "feed2")
    assert out.count() == 4


def test_silver_levels_reset_in_one_batch(spark):
    raw = spark.createDataFrame(
        [(json.dumps({"type": "l2update", "product_id": "X", "time": "2024-01-01T00:00:00Z",
                      "changes": [["buy", "5", "1"]]}), T0),
         (json.dumps({"type": "snapshot", "product_id": "X", "bids": [["1", "1"]]}), T0 + dt.timedelta(minutes=1))],
        "value string, ingest_time timestamp")
    b = bronze.parse_orderbook(raw, ingest_time="ingest_time")
    assert silver.silver_levels(b).count() == 2
    assert [r["price"] for r in silver.silver_levels(b, reset_on_snapshot=True).collect()] == [1.0]


def test_full_refresh_catalog_table(spark, tmp_dir):
    create_namespaces(spark)
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    full_refresh(df, table="gold.refresh_probe")
    full_refresh(df.where("k = 2"), table="gold.refresh_probe")
    assert [r["k"] for r in spark.table("gold.refresh_probe").collect()] == [2]
    # the table rebuilt from itself
    full_refresh(spark.table("gold.refresh_probe").withColumn("v", F.lit("c")), table="gold.refresh_probe")
    assert [tuple(r) for r in spark.table("gold.refresh_probe").collect()] == [(2, "c")]
