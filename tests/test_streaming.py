import datetime as dt
import json
import pathlib

import pytest

from pyspark.sql import functions as F

from tapehouse.operators import bronze
from tapehouse.sources.feed import file_batch, file_stream
from tapehouse.sources.publish import publish_records, write_feed_files
from tapehouse.streaming.bronze import start_append, start_bronze, bronze_trades
from tapehouse.plans.fixtures import book_feed, events, trade_feed


def test_publish_records_unknown_key_and_order(spark):
    df = spark.createDataFrame([(None, 1), ("A", 2), ("A", 1)], "product_id string, seq long")
    recs = publish_records(df, key="product_id", order=["seq"])
    got = [(r["key"], json.loads(r["value"]).get("seq")) for r in recs.collect()]
    assert ("unknown", 1) in got
    a = [s for k, s in got if k == "A"]
    assert a == [1, 2]


def test_ordered_publish_spreads_a_hot_key(spark, tmp_dir):
    df = spark.range(2000).selectExpr("IF(id % 10 = 0, NULL, 'A') AS product_id", "(id * 7919) % 2000 AS seq")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        recs = publish_records(df.repartition(4), order=["seq"], whole_keys=False)
        sizes = [n for n in recs.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]
        write_feed_files(recs, f"{tmp_dir}/feed")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 1000
    lines = [json.loads(x) for f in sorted(pathlib.Path(f"{tmp_dir}/feed").glob("part-*")) for x in f.read_text().splitlines()]
    for product in ("A", None):
        seqs = [r["seq"] for r in lines if r.get("product_id") == product]
        assert seqs == sorted(seqs) and len(seqs) == (1800 if product else 200)


def test_bronze_file_stream_equals_batch_and_resumes(spark, tmp_dir):
    ev = events(spark, "/root/testdata/sf0.001")
    write_feed_files(trade_feed(ev), f"{tmp_dir}/feed/trades")
    write_feed_files(book_feed(ev), f"{tmp_dir}/feed/book")
    book_q, trade_q = start_bronze(
        file_stream(spark, f"{tmp_dir}/feed/book"), file_stream(spark, f"{tmp_dir}/feed/trades"),
        f"{tmp_dir}/bronze/orderbook_events", f"{tmp_dir}/bronze/trades", f"{tmp_dir}/ckpt",
        available_now=True)
    book_q.awaitTermination(120)
    trade_q.awaitTermination(120)
    seen = sum(p["observedMetrics"]["bronze_trades_feed"]["messages"]
               for p in trade_q.recentProgress if "bronze_trades_feed" in p.get("observedMetrics", {}))
    assert seen == ev.count()
    streamed = spark.read.parquet(f"{tmp_dir}/bronze/trades")
    batch = bronze.parse_trades(file_batch(spark, f"{tmp_dir}/feed/trades"))
    cols = ["trade_id", "sequence", "product_id", "price", "size", "side", "time", "raw_payload"]
    assert sorted(map(tuple, streamed.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))
    assert spark.read.parquet(f"{tmp_dir}/bronze/orderbook_events").count() == ev.count()
    assert "ingest_time_date" in streamed.columns

    # restart from the checkpoints with no new files: nothing is added
    book_q, trade_q = start_bronze(
        file_stream(spark, f"{tmp_dir}/feed/book"), file_stream(spark, f"{tmp_dir}/feed/trades"),
        f"{tmp_dir}/bronze/orderbook_events", f"{tmp_dir}/bronze/trades", f"{tmp_dir}/ckpt",
        available_now=True)
    book_q.awaitTermination(120)
    trade_q.awaitTermination(120)
    assert spark.read.parquet(f"{tmp_dir}/bronze/trades").count() == ev.count()


def test_ingest_time_constant_within_batch(spark, tmp_dir):
    ev = events(spark, "/root/testdata/sf0.001")
    write_feed_files(trade_feed(ev), f"{tmp_dir}/feed")
    q = start_append(bronze_trades(file_stream(spark, f"{tmp_dir}/feed")), checkpoint=f"{tmp_dir}/ck",
                     path=f"{tmp_dir}/out", available_now=True)
    q.awaitTermination(120)
    out = spark.read.parquet(f"{tmp_dir}/out")
    assert out.select("ingest_time").distinct().count() == 1
    assert out.where("ingest_time > current_timestamp()").count() == 0
    assert out.agg({"ingest_time": "max"}).first()[0] <= dt.datetime.now() + dt.timedelta(days=1)


def test_stream_keeps_unparseable_messages(spark, tmp_dir):
    lines = ['{"type":"l2update","product_id":"X","time":"2024-01-01T00:00:01Z","changes":[["buy","1","2"]]}',
             "nope", '{"type":"snapshot","product_id":"X","bids":[]}', "{broken"]
    spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.text(f"{tmp_dir}/feed")
    from tapehouse.streaming.bronze import bronze_orderbook
    q = start_append(bronze_orderbook(file_stream(spark, f"{tmp_dir}/feed")), checkpoint=f"{tmp_dir}/ck",
                     path=f"{tmp_dir}/out", partition_by="ingest_time_date", available_now=True)
    q.awaitTermination(120)
    out = spark.read.parquet(f"{tmp_dir}/out")
    assert out.count() == 4
    bad = sorted(r["payload"] for r in out.where("type IS NULL").collect())
    assert bad == ["nope", "{broken"]
    metrics = [p["observedMetrics"]["bronze_orderbook_feed"] for p in q.recentProgress
               if "bronze_orderbook_feed" in p.get("observedMetrics", {})]
    assert sum(m["unparsed"] for m in metrics) == 2 and sum(m["orderbook"] for m in metrics) == 2


def _gap_feed(spark, folder, rows, number):
    """Rows (product, type, sequence, offset) as one file of the stream."""
    ddl = "product_id string, type string, sequence long, off long"
    spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(f"{folder}/b{number}")


def test_stream_gaps_equal_batch_gaps_over_restarts(spark, tmp_dir):
    import random

    from tapehouse.operators.quality import sequence_gaps
    from tapehouse.streaming.bronze import start_append
    from tapehouse.streaming.gaps import stream_sequence_gaps

    rnd, off, at, feed = random.Random(11), 0, {}, []
    big = 2**53  # sequences beyond exact doubles
    for _ in range(5):
        batch = []
        for _ in range(60):
            p = rnd.choice(["A", "A", "A", "B", "C", None])
            at[p] = at.get(p, big) + rnd.choice([1, 1, 1, 2, 5, -3])
            kind = "snapshot" if rnd.random() < 0.08 else "l2update"
            batch.append((p, kind, None if rnd.random() < 0.1 else at[p], off))
            off += 1
        rnd.shuffle(batch)
        feed.append(batch)
    everything = spark.createDataFrame([r for b in feed for r in b], "product_id string, type string, sequence long, off long")
    for reset in (None, F.col("type") == "snapshot"):
        tag = "plain" if reset is None else "reset"
        src, out, ckpt = (f"{tmp_dir}/{tag}/{x}" for x in ("in", "out", "ckpt"))
        for i, batch in enumerate(feed):
            _gap_feed(spark, src, batch, i)
            stream = spark.readStream.schema(everything.schema).parquet(f"{src}/*")
            q = start_append(stream_sequence_gaps(stream, order=["off"], reset=reset), ckpt, path=out, available_now=True)
            q.awaitTermination(120)  # every batch is another start from the checkpoint
        expected = sequence_gaps(everything, order=["off"], reset=reset)
        got = spark.read.parquet(out)
        assert got.columns == expected.columns
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
        assert got.count() > 5


def _counting(spark, tmp_dir, name, fails=None):
    """A start function of an available-now stream over ``in``; while ``fails`` holds True its rows raise."""
    def start():
        stream = spark.readStream.schema("v long").parquet(f"{tmp_dir}/in")
        if fails and fails.pop(0):
            stream = stream.withColumn("v", F.when(F.col("v") >= 0, F.raise_error(F.lit("sink down"))).otherwise(F.col("v")).cast("long"))
        stream = stream.observe(name, F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"))
        return start_append(stream, f"{tmp_dir}/ckpt-{name}", path=f"{tmp_dir}/out-{name}", available_now=True, name=name)

    return start


def test_a_group_restarts_from_its_checkpoints_and_logs_progress(spark, tmp_dir):
    from tapehouse.streaming.supervise import ProgressLog, Restarts, run_group

    log = ProgressLog(spark, f"{tmp_dir}/progress")
    once = Restarts(most=2, wait=0.1)
    spark.range(10).toDF("v").coalesce(1).write.parquet(f"{tmp_dir}/in")
    group = [_counting(spark, tmp_dir, "left"), _counting(spark, tmp_dir, "right", fails=[True, False, False, True, True, True])]
    assert run_group(spark, group, once, log, poll=0.2) == 1
    spark.range(10, 25).toDF("v").coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
    assert run_group(spark, group, once, log, poll=0.2) == 0
    for name in ("left", "right"):
        assert sorted(r["v"] for r in spark.read.parquet(f"{tmp_dir}/out-{name}").collect()) == list(range(25))
    seen = spark.read.parquet(f"{tmp_dir}/progress")
    counts = {(r["query"], r["batch"]): r["value"] for r in seen.where("metric LIKE '%.n'").collect()}
    assert counts == {("left", 0): 10, ("right", 0): 10, ("left", 1): 15, ("right", 1): 15}
    assert seen.where("metric IS NULL").select("query", "batch").distinct().count() == 4
    totals = {r["value"] for r in seen.where("metric = 'left.total'").collect()}
    assert totals == {45, sum(range(10, 25))}
    spark.range(25, 30).toDF("v").coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
    with pytest.raises(Exception, match="sink down"):
        run_group(spark, group, once, log, poll=0.2)
    assert not spark.streams.active


def test_a_replayed_batch_changes_nothing(spark, tmp_dir):
    """The step that ``start_silver`` hands to ``foreachBatch``, over batches as a stream gives them."""
    from tapehouse.plans.layers import Lake, run_gold, silver_trades_step
    from tapehouse.sources.tables import scan
    from tapehouse.sources.versions import Conflict, Table
    from tapehouse.streaming import silver as following

    ev = events(spark, "/root/testdata/sf0.001")
    trades = bronze.parse_trades(trade_feed(ev, redeliver=True), ingest_time="ingest_time").withColumn("ingest_time", F.col("ingest_time").cast("timestamp"))
    parts = [trades.where(F.col("ingest_time") < "2024-01-15"), trades.where(F.col("ingest_time") >= "2024-01-15")]
    lake = Lake(f"{tmp_dir}/lake")
    step = following.trades_batch(lake, "live")
    assert step(parts[0], 0) and not step(parts[0], 0)
    table = Table(spark, lake.silver_trades)
    first = table.current()
    real = Table.publish
    try:  # dies after its files are written
        Table.publish = lambda *a: (_ for _ in ()).throw(Conflict("died"))
        with pytest.raises(Conflict):
            step(parts[1], 1)
    finally:
        Table.publish = real
    assert table.current() == first
    assert step(parts[1], 1) and not step(parts[1], 1) and not step(parts[0], 0)
    assert step(parts[1].where("false"), 2) and not step(parts[1], 2)  # an empty batch counts too
    assert table.mark("batch:live") == 2
    trades.write.parquet(lake.bronze_trades)
    other = Lake(f"{tmp_dir}/batch")
    trades.write.parquet(other.bronze_trades)
    silver_trades_step(spark, other)
    names = scan(spark, other.silver_trades).columns
    assert sorted(map(str, scan(spark, lake.silver_trades).select(names).collect())) == sorted(map(str, scan(spark, other.silver_trades).collect()))
    assert silver_trades_step(spark, lake).rows == 0  # a scheduled run finds the marks of the stream
    run_gold(spark, lake)
    assert scan(spark, lake.gold_ohlcv).agg(F.sum("trade_count")).first()[0] == ev.count()


def test_producer_options_keep_order_and_can_be_changed():
    from tapehouse.sources.publish import producer_options

    kept = producer_options("host:1", "t", {})
    assert kept == {
        "kafka.bootstrap.servers": "host:1", "topic": "t", "kafka.acks": "all", "kafka.retries": "5",
        "kafka.max.in.flight.requests.per.connection": "1",
    }
    assert producer_options("host:1", "t", {"kafka.acks": "1"})["kafka.acks"] == "1"


def test_ordered_files_spread_a_hot_key(spark, tmp_dir):
    from tapehouse.sources.publish import write_ordered_feed_files

    rows = [("A", i) for i in range(3000)] + [("B", i) for i in range(10)]
    df = spark.createDataFrame(rows, "product_id string, seq long").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one file
    write_ordered_feed_files(df, f"{tmp_dir}/feed", ["seq"])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted(pathlib.Path(f"{tmp_dir}/feed").glob("part-*"))
    read = [json.loads(line) for f in files for line in f.read_text().splitlines()]
    assert [(r["product_id"], r["seq"]) for r in read] == rows
    assert max(sum(1 for _ in f.open()) for f in files) < 2500
