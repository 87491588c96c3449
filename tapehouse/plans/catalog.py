"""The layers as catalog tables.

Parquet tables are external tables over the folders of a ``Lake``: the layer
runs of ``plans.layers`` write the folders, partition by partition and safe
against interruption, and ``sync`` brings the catalog up to them. Formats with
row-level operations (Iceberg, Delta) merge into the tables themselves:
``run_tables``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tapehouse.operators import gold, silver
from tapehouse.operators.upsert import merge_into_table
from tapehouse.plans.layers import Lake, run_all
from tapehouse.schemas import LEVEL_KEYS, SILVER_LEVELS_COLUMNS, SILVER_TRADES_COLUMNS, TABLE_DDL
from tapehouse.sources.tables import create_namespaces, create_table, full_refresh, sync_partitions

Merge = Callable[[SparkSession, str, DataFrame, Sequence[str]], None]


def bootstrap(spark: SparkSession, lake: Lake | None = None, using: str = "parquet", catalog: str | None = None) -> None:
    """Namespaces and tables of all layers, where they do not exist yet.

    With a ``lake`` the tables lie over its folders; without one the catalog
    chooses their place.
    """
    create_namespaces(spark, catalog)
    for name in TABLE_DDL:
        create_table(spark, name, using, lake.table_path(name) if lake else None, catalog)
    if lake:
        sync(spark, lake)


def sync(spark: SparkSession, lake: Lake) -> None:
    """Bring the catalog's partitions of all layer tables up to the lake's folders."""
    for name in TABLE_DDL:
        sync_partitions(spark, name, lake.table_path(name))


def run_lake_tables(spark: SparkSession, lake: Lake, full_gold: bool = False) -> dict[str, int]:
    """Bootstrap, one run of all layers, and the catalog brought up to it."""
    bootstrap(spark, lake)
    counts = run_all(spark, lake, full_gold=full_gold)
    sync(spark, lake)
    return counts


def run_tables(
    spark: SparkSession, catalog: str | None = None, using: str = "iceberg", merge: Merge = merge_into_table
) -> None:
    """One run of all layers on tables with row-level operations: silver is merged, gold rebuilt.

    The bounds are those of the tables themselves (the largest ingest time of
    trades, the largest event time of levels); an empty table is a first run.
    Each merge and each rebuild is one commit of the table's format.
    """

    def full(name: str) -> str:
        return f"{catalog}.{name}" if catalog else name

    levels, trades = full("silver.stg_orderbook_levels"), full("silver.stg_trades")
    stored = spark.table(levels).select(*SILVER_LEVELS_COLUMNS)
    merge(spark, levels, silver.silver_levels(spark.table(full("bronze.orderbook_events")), stored), LEVEL_KEYS)
    full_refresh(gold.top_of_book(spark.table(levels)), table=full("gold.gold_top_of_book"), using=using)
    stored = spark.table(trades).select(*SILVER_TRADES_COLUMNS)
    fresh = silver.clean_trades(spark.table(full("bronze.trades")), stored, inline_bound=True)
    merge(spark, trades, fresh, ["trade_id"])
    full_refresh(gold.ohlcv(spark.table(trades), "1 minute"), table=full("gold.gold_ohlcv_1min"), using=using)
