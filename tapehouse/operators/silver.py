"""Silver layer: incremental selection, de-duplication, order-book levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tapehouse.functions import element, event_time_fallback, to_double, typed_null
from tapehouse.schemas import BOOK_BODY_DDL, LEVEL_KEYS, SILVER_LEVELS_COLUMNS, SILVER_TRADES_COLUMNS

EPOCH = "1970-01-01 00:00:00"


def high_water_mark(target: DataFrame, column: str) -> Column:
    """Uncorrelated scalar subquery ``coalesce(max(column), epoch)`` over the target."""
    dtype = target.schema[column].dataType
    return target.select(
        F.coalesce(F.max(column), F.lit(EPOCH).cast(dtype)).alias("hwm")
    ).scalar()


def incremental_since(
    df: DataFrame,
    target: DataFrame | None,
    on: str = "ingest_time",
    target_col: str | None = None,
    inline: bool = False,
) -> DataFrame:
    """Rows of ``df`` strictly newer than the target's high-water mark.

    ``target=None`` is the first run: everything is selected. The bound is a
    scalar subquery; ``inline=True`` computes it first (one row) and inlines
    it as a literal so that Parquet row groups are skipped, and, when ``df``
    carries the day column ``<on>_date`` it is partitioned by, whole days
    before the bound are pruned as well.
    """
    if target is None:
        return df
    col_name = target_col or on
    if inline:
        dtype = target.schema[col_name].dataType
        bound = target.select(
            F.coalesce(F.max(col_name), F.lit(EPOCH).cast(dtype)).alias("hwm")
        ).first()["hwm"]
        lit = F.lit(bound).cast(df.schema[on].dataType)
        out = df.where(F.col(on) > lit)
        day = f"{on}_date"
        if day in df.columns:
            out = out.where(F.col(day) >= F.to_date(lit))
        return out
    return df.where(F.col(on) > high_water_mark(target, col_name))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order`` (rank-1 window).

    Spark plans this as a partial WindowGroupLimit before the shuffle, so a
    key with very many copies is cut to one row per map partition before
    it is moved.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def clean_trades(
    bronze: DataFrame, target: DataFrame | None = None, inline_bound: bool = False
) -> DataFrame:
    """Silver trades: required fields present, newer than the target, one row per trade_id.

    Latest ``ingest_time`` wins; ties fall to the higher sequence, then a
    hash of the row, so the choice is deterministic.
    """
    src = bronze.where(
        F.col("trade_id").isNotNull() & F.col("product_id").isNotNull() & F.col("time").isNotNull()
    )
    src = incremental_since(src, target, on="ingest_time", inline=inline_bound)
    src = src.select(*SILVER_TRADES_COLUMNS)
    order = [
        F.col("ingest_time").desc(),
        F.col("sequence").desc_nulls_last(),
        F.xxhash64(*SILVER_TRADES_COLUMNS).desc(),
    ]
    return latest_per_key(src, ["trade_id"], order)


def _level(side: Column, price: Column, size: Column) -> Column:
    return F.struct(side.alias("side"), price.alias("price_str"), size.alias("size_str"))


def flatten_levels(bronze: DataFrame, snapshot_time: str = "ingest", keep_ingest: bool = False) -> DataFrame:
    """Order-book messages to one row per price level, in a single pass.

    Snapshot bids become ``buy`` levels and asks ``sell`` levels with a null
    sequence; update changes ``[side, price, size]`` keep the message
    sequence. An empty or missing array yields no rows, a short entry yields
    null fields. Event time of an update is its parsed ``time`` or, when
    that fails, its ingest time; of a snapshot its ingest time
    (``snapshot_time="ingest"``, as the source system does) or its own
    time where present (``"envelope"``). ``keep_ingest`` carries the
    message's ingest time along (for an ingest-clock watermark).
    """
    ingest_type = bronze.schema["ingest_time"].dataType
    body = F.from_json(F.col("payload"), BOOK_BODY_DDL)
    level_type = StructType(
        [StructField(n, StringType()) for n in ("side", "price_str", "size_str")]
    )
    empty = F.array().cast(f"array<{level_type.simpleString()}>")

    bids = F.transform(body["bids"], lambda x: _level(F.lit("buy"), element(x, 0), element(x, 1)))
    asks = F.transform(body["asks"], lambda x: _level(F.lit("sell"), element(x, 0), element(x, 1)))
    changes = F.transform(
        body["changes"], lambda x: _level(element(x, 0), element(x, 1), element(x, 2))
    )
    is_snap = F.col("type") == "snapshot"
    levels = (
        F.when(is_snap, F.concat(F.coalesce(bids, empty), F.coalesce(asks, empty)))
        .when(F.col("type") == "l2update", changes)
    )
    msg_time = event_time_fallback("time", "ingest_time", ingest_type)
    snap_time = F.col("ingest_time") if snapshot_time == "ingest" else msg_time
    return (
        bronze.where(F.col("type").isin("snapshot", "l2update"))
        .select(
            "product_id",
            F.when(is_snap, snap_time).otherwise(msg_time).alias("event_time"),
            F.when(is_snap, typed_null("bigint")).otherwise(F.col("sequence")).alias("sequence"),
            *(["ingest_time"] if keep_ingest else []),
            F.explode(levels).alias("_lvl"),
        )
        .select(
            "product_id",
            F.col("_lvl.side").alias("side"),
            to_double("_lvl.price_str").alias("price"),
            to_double("_lvl.size_str").alias("size"),
            "event_time",
            "sequence",
            *(["ingest_time"] if keep_ingest else []),
        )
    )


def level_order() -> list[Column]:
    """Newest event_time, then highest sequence (nulls last), then size for determinism."""
    return [
        F.col("event_time").desc_nulls_last(),
        F.col("sequence").desc_nulls_last(),
        F.col("size").desc_nulls_last(),
    ]


def latest_levels(levels: DataFrame) -> DataFrame:
    """Latest row per (product_id, side, price) by ``level_order``.

    Keeps a carried ``ingest_time`` column when the input has one.
    """
    cols = SILVER_LEVELS_COLUMNS + (["ingest_time"] if "ingest_time" in levels.columns else [])
    return latest_per_key(levels, LEVEL_KEYS, level_order()).select(*cols)


def silver_levels(
    bronze: DataFrame,
    target: DataFrame | None = None,
    snapshot_time: str = "ingest",
    watermark_col: str = "event_time",
    inline_bound: bool = False,
    reset_on_snapshot: bool = False,
) -> DataFrame:
    """Silver order-book levels from bronze: incremental, flattened, latest per level.

    ``reset_on_snapshot=True`` leaves out messages that arrived before the
    newest snapshot of their product in this batch (see ``since_snapshot``);
    stored levels of a product with a snapshot are older than it.

    The incremental bound compares bronze ``ingest_time`` with the target's
    ``max(event_time)`` (the source system's rule, which mixes the exchange
    and ingest clocks: an exchange clock running ahead skips rows for good).
    ``watermark_col="ingest_time"`` compares ingest time with ingest time
    instead; the output then carries ``ingest_time`` so the next run can.
    """
    src = incremental_since(
        bronze, target, on="ingest_time", target_col=watermark_col, inline=inline_bound
    )
    keep = watermark_col == "ingest_time"
    if reset_on_snapshot:
        src = since_snapshot(src)
    return latest_levels(flatten_levels(src, snapshot_time=snapshot_time, keep_ingest=keep))


#: Columns that tell the order of messages of one ingest time, where bronze carries one.
ARRIVAL = ("offset", "msg_offset")


def since_snapshot(bronze: DataFrame) -> DataFrame:
    """Messages that did not arrive before the newest snapshot of their product.

    A reconnect sends a full snapshot; levels it no longer lists are stale.
    The source system keeps them (so its book can cross after a reconnect);
    this is the opt-in correction. Messages arrive by ingest time, which a
    micro-batch shares, then by the offset where there is one; without it a
    message of the snapshot's ingest time counts as later. Exchange times play
    no part: they are another clock.
    """
    order = ["ingest_time", *(c for c in ARRIVAL if c in bronze.columns)]
    arrival = F.struct(*order)
    newest = (
        bronze.where(F.col("type") == "snapshot")
        .groupBy(F.col("product_id").alias("_product"))
        .agg(F.max(arrival).alias("_snapshot"))  # one row a product: the join multiplies no message
    )
    same = F.col("product_id").eqNullSafe(F.col("_product"))
    fresh = F.col("_snapshot").isNull() | (arrival >= F.col("_snapshot"))
    return bronze.join(newest, same, "left").where(fresh).select(*bronze.columns)
