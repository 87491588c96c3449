import os

import duckdb

import __spark_entry__ as entry
from tapehouse.plans.oracle import ORACLE_SQL
from tapehouse.plans.queries import QUERIES
from tools.check_oracle import TABLES, frame_hash

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["product_id", "bucket", "open", "high", "low", "close", "volume", "vwap", "trade_count"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_match_duckdb_oracle(spark):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    sql = entry.oracle_sql()
    bad = []
    for name, fn in QUERIES.items():
        a = frame_hash(fn(spark, SF).toPandas())
        b = frame_hash(con.execute(sql[name]).df())
        if a != b:
            bad.append((name, a[:2], b[:2]))
    assert not bad, bad
