import pytest
from pyspark.sql import functions as F

from tapehouse.operators.upsert import upsert
from tapehouse.plans import catalog
from tapehouse.plans.fixtures import book_feed, events, trade_feed
from tapehouse.plans.layers import Lake, run_all
from tapehouse.schemas import TABLE_DDL
from tapehouse.sources.feed import file_stream
from tapehouse.sources.publish import write_feed_files
from tapehouse.sources.tables import full_refresh, scan
from tapehouse.sources.versions import Table
from tapehouse.streaming.bronze import start_bronze

CUT = "2024-01-15"


@pytest.fixture()
def no_tables(spark):
    def drop():
        for name in TABLE_DDL:
            spark.sql(f"DROP TABLE IF EXISTS {name}")

    for ns in ("bronze", "silver", "gold"):
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {ns}")
    drop()
    yield
    drop()


def _append(spark, root, ev, out):
    """The events as feed files, taken up by both streams (which resume from their checkpoints)."""
    write_feed_files(trade_feed(ev), f"{root}/feed/trades")
    write_feed_files(book_feed(ev), f"{root}/feed/book")
    queries = start_bronze(
        file_stream(spark, f"{root}/feed/book"), file_stream(spark, f"{root}/feed/trades"), *out, f"{root}/ckpt",
        available_now=True)
    for q in queries:
        q.awaitTermination(120)


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_stream_to_tables_and_two_runs(spark, tmp_dir, no_tables):
    lake = Lake(f"{tmp_dir}/lake")
    ev = events(spark, "/root/testdata/sf0.001")
    names = ("bronze.orderbook_events", "bronze.trades")
    catalog.bootstrap(spark, lake)
    catalog.bootstrap(spark, lake)  # nothing to do
    assert spark.table("gold.gold_ohlcv_1min").count() == 0
    _append(spark, tmp_dir, ev.where(F.col("ts") < CUT), names)
    catalog.run_lake_tables(spark, lake)
    first = spark.table("gold.gold_ohlcv_1min").count()
    _append(spark, tmp_dir, ev.where(F.col("ts") >= CUT), names)
    catalog.run_lake_tables(spark, lake)
    assert spark.table("bronze.trades").count() == spark.table("bronze.orderbook_events").count() == ev.count()
    assert spark.table("silver.stg_trades").count() == ev.count()
    assert spark.table("gold.gold_ohlcv_1min").count() > first
    for name in TABLE_DDL:
        stored = scan(spark, lake.table_path(name))
        assert _rows(spark.table(name)) == _rows(stored), name
        assert spark.table(name).schema.simpleString().count("void") == 0
    # another session, whose catalog is empty, creates the tables over what is there
    for name in TABLE_DDL:
        spark.sql(f"DROP TABLE {name}")
    catalog.bootstrap(spark, lake)
    for name in TABLE_DDL:
        assert _rows(spark.table(name)) == _rows(scan(spark, lake.table_path(name))), name
    # bars rebuilt in full from the same silver are the same
    catalog.run_lake_tables(spark, lake, full_gold=True)
    assert spark.table("gold.gold_ohlcv_1min").agg(F.sum("trade_count")).first()[0] == ev.count()


def test_removed_partitions_leave_the_catalog(spark, tmp_dir, no_tables):
    lake = Lake(f"{tmp_dir}/lake")
    row = "1L AS trade_id, 1L AS sequence, 'A' AS product_id, 1D AS price, 1D AS size, 'buy' AS side"
    trades = spark.sql(f"SELECT {row}, TIMESTAMP '2024-01-01 00:00:00' AS time, TIMESTAMP '2024-01-01 00:00:01' AS "
                       "ingest_time, d AS time_date FROM VALUES (DATE '2024-01-01'), (DATE '2024-01-02') AS t(d)")
    catalog.bootstrap(spark, lake)
    for days in (2, 1):
        table = Table(spark, lake.silver_trades)
        table.write(trades.where(F.dayofmonth("time_date") <= days), "time_date", table.current())
        catalog.sync(spark, lake)
        assert spark.sql("SHOW PARTITIONS silver.stg_trades").count() == days
        assert spark.table("silver.stg_trades").count() == days


def test_merging_tables_equal_the_lake(spark, tmp_dir, no_tables):
    """MERGE itself needs a format with row-level operations; here the merge is the upsert of the same rows."""
    def rewrite(spark, table, source, keys):
        target = spark.table(table)
        full_refresh(upsert(target, source.select(*target.columns), keys), table=table)

    lake = Lake(f"{tmp_dir}/lake")
    ev = events(spark, "/root/testdata/sf0.001")
    catalog.bootstrap(spark)
    for i, part in enumerate((F.col("ts") < CUT, F.col("ts") >= CUT)):
        _append(spark, tmp_dir, ev.where(part), (lake.bronze_orderbook, lake.bronze_trades))
        for name in ("bronze.orderbook_events", "bronze.trades"):
            columns = spark.table(name).columns
            scan(spark, lake.table_path(name)).select(*columns).write.mode("overwrite").insertInto(name)
        catalog.run_tables(spark, using="parquet", merge=rewrite)
        run_all(spark, lake)
        for name in ("silver.stg_trades", "silver.stg_orderbook_levels", "gold.gold_ohlcv_1min", "gold.gold_top_of_book"):
            table = spark.table(name)
            assert _rows(table) == _rows(scan(spark, lake.table_path(name)).select(*table.columns)), (i, name)
