from pyspark.sql import functions as F

from tapehouse.operators import bronze
from tapehouse.plans.fixtures import book_feed, events, trade_feed
from tapehouse.plans.layers import Lake, run_all, run_silver_trades
from tapehouse.sources.tables import scan, with_day_partition
from tapehouse.sources.versions import Table


def _write_bronze(spark, lake, ev, mode="append"):
    t = bronze.parse_trades(trade_feed(ev), ingest_time="ingest_time").withColumn(
        "ingest_time", F.col("ingest_time").cast("timestamp"))
    with_day_partition(t, "ingest_time").write.mode(mode).partitionBy("ingest_time_date").parquet(
        lake.bronze_trades)
    b = bronze.parse_orderbook(book_feed(ev), ingest_time="ingest_time").withColumn(
        "ingest_time", F.col("ingest_time").cast("timestamp"))
    with_day_partition(b, "ingest_time").write.mode(mode).partitionBy("ingest_time_date").parquet(
        lake.bronze_orderbook)


def test_two_runs_and_idempotence(spark, tmp_dir):
    lake = Lake(tmp_dir)
    ev = events(spark, "/root/testdata/sf0.001")
    cut = "2024-01-15 00:00:00"
    _write_bronze(spark, lake, ev.where(F.col("ts") < cut))
    first = run_all(spark, lake)
    assert first["silver_trades"] > 0
    _write_bronze(spark, lake, ev.where(F.col("ts") >= cut))
    run_all(spark, lake)
    silver = scan(spark, lake.silver_trades)
    assert silver.count() == ev.count()
    assert silver.groupBy("trade_id").count().where("count > 1").count() == 0
    # a third run on unchanged bronze adds nothing
    assert run_silver_trades(spark, lake) == 0
    bars = scan(spark, lake.gold_ohlcv)
    assert bars.agg(F.sum("trade_count")).first()[0] == ev.count()
    # the incremental gold equals a full rebuild from silver
    from tapehouse.operators import gold as gold_ops
    full = gold_ops.ohlcv(silver.select("trade_id", "product_id", "price", "size", "time"), "1 minute")
    cols = ["product_id", "bucket", "open", "high", "low", "close", "volume", "trade_count"]
    assert sorted(map(tuple, bars.select(cols).collect())) == sorted(map(tuple, full.select(cols).collect()))
    levels = scan(spark, lake.silver_levels)
    assert levels.groupBy("product_id", "side", "price").count().where("count > 1").count() == 0
    tob = scan(spark, lake.gold_top_of_book)
    assert tob.count() == levels.select("product_id").distinct().count()


def test_incremental_bound_prunes_bronze_days(spark, tmp_dir):
    from tapehouse.operators import silver

    lake = Lake(tmp_dir)
    ev = events(spark, "/root/testdata/sf0.001")
    _write_bronze(spark, lake, ev)
    bronze_t = spark.read.parquet(lake.bronze_trades)
    target = silver.clean_trades(bronze_t.where(F.col("ingest_time") < "2024-01-20"))
    inc = silver.incremental_since(bronze_t, target, on="ingest_time", inline=True)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    plan = inc._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    part = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "ingest_time_date" in part and ">=" in part
    assert inc.count() == ev.where(F.col("ts") >= "2024-01-20").count()


def test_a_merge_without_a_mark_is_read_again(spark, tmp_dir):
    from tapehouse.operators import silver as silver_ops
    from tapehouse.plans.layers import HWM
    from tapehouse.sources.tables import upsert_parquet

    lake = Lake(tmp_dir)
    ev = events(spark, "/root/testdata/sf0.001")
    cut = "2024-01-15 00:00:00"
    _write_bronze(spark, lake, ev.where(F.col("ts") < cut))
    run_silver_trades(spark, lake)
    first_mark = Table(spark, lake.silver_trades).mark(HWM)
    _write_bronze(spark, lake, ev.where(F.col("ts") >= cut))
    # a merge of part of the new rows that leaves the mark
    part = silver_ops.clean_trades(spark.read.parquet(lake.bronze_trades).where(F.col("ingest_time") >= "2024-01-25"))
    upsert_parquet(spark, lake.silver_trades, part.withColumn("time_date", F.to_date("time")),
                   ["trade_id"], "time_date")
    assert Table(spark, lake.silver_trades).mark(HWM) == first_mark
    run_silver_trades(spark, lake)  # the retry reads from the committed mark
    silver_t = scan(spark, lake.silver_trades)
    assert silver_t.count() == ev.count()
    assert silver_t.groupBy("trade_id").count().where("count > 1").count() == 0
    assert Table(spark, lake.silver_trades).mark(HWM) > first_mark


def test_silver_writes_few_files(spark, tmp_dir):
    lake = Lake(tmp_dir)
    _write_bronze(spark, lake, events(spark, "/root/testdata/sf0.001"))
    run_silver_trades(spark, lake)
    files = scan(spark, lake.silver_trades).select("time_date", F.input_file_name().alias("f"))
    assert files.groupBy("time_date").agg(F.countDistinct("f").alias("n")).agg(F.max("n")).first()[0] == 1


def test_ingest_watermark_takes_messages_that_the_event_clock_skips(spark, tmp_dir):
    """The exchange clock runs ahead: the default bound skips later messages, the ingest bound does not."""
    from tapehouse.plans.layers import run_silver_levels

    def message(product, seq, sent, ingest):
        text = (f'{{"type":"l2update","product_id":"{product}","time":"{sent}","sequence":{seq},'
                f'"changes":[["buy","10","1"]]}}')
        raw = spark.createDataFrame([(text, ingest)], "value string, t string")
        return bronze.parse_orderbook(raw, ingest_time=F.col("t").cast("timestamp"))

    first = message("A", 1, "2024-01-01T12:00:00.000000Z", "2024-01-01 10:00:00")
    second = message("B", 2, "2024-01-01T10:30:00.000000Z", "2024-01-01 11:00:00")
    for watermark, products in (("event_time", ["A"]), ("ingest_time", ["A", "B"])):
        lake = Lake(f"{tmp_dir}/{watermark}")
        for batch in (first, second):
            with_day_partition(batch, "ingest_time").write.mode("append").partitionBy("ingest_time_date").parquet(
                lake.bronze_orderbook)
            run_silver_levels(spark, lake, watermark=watermark)
        got = scan(spark, lake.silver_levels).select("product_id").collect()
        assert sorted(r[0] for r in got) == products
        assert run_silver_levels(spark, lake, watermark="ingest_time") == (0 if watermark == "ingest_time" else 2)
