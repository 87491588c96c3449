"""Bronze ingest as stateless append-only streaming queries.

Each query parses raw feed messages (keeping the raw text), stamps the
ingest time of the micro-batch and appends to a day-partitioned table.
Delivery is exactly-once per checkpoint: a restarted query resumes from
its checkpoint (``startingOffsets`` only applies to the very first start),
and the file sink's commit log ignores a re-run batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pyspark.sql import functions as F

from tapehouse.operators.bronze import parse_orderbook, parse_trades
from tapehouse.operators.quality import observe_feed
from tapehouse.sources.tables import with_day_partition

DEFAULT_TRIGGER = "10 seconds"


def bronze_orderbook(raw: DataFrame, value_col: str = "value", observe: bool = True) -> DataFrame:
    """Order-book bronze rows, partition column ``ingest_time_date`` added.

    With ``observe`` every micro-batch reports ``bronze_orderbook_feed``
    metrics (messages, order-book, trade and unparsed counts) in its
    progress, the stream's message counter.
    """
    out = with_day_partition(parse_orderbook(raw, value_col), "ingest_time")
    return observe_feed(out, "bronze_orderbook_feed") if observe else out


def bronze_trades(raw: DataFrame, value_col: str = "value", observe: bool = True) -> DataFrame:
    """Trade bronze rows, partition column ``ingest_time_date`` added.

    Partitioned by ingest day rather than trade day: silver reads bronze
    incrementally by ingest time, so it then only opens the newest days
    (a late trade with an old ``time`` still lands in today's partition).
    """
    out = with_day_partition(parse_trades(raw, value_col), "ingest_time")
    if not observe:
        return out
    return out.observe(
        "bronze_trades_feed",
        F.count(F.lit(1)).alias("messages"),
        F.count(F.when(F.col("trade_id").isNull(), 1)).alias("unparsed"),
    )


def start_append(
    df: DataFrame,
    checkpoint: str,
    path: str | None = None,
    table: str | None = None,
    partition_by: str | None = None,
    trigger: str | None = DEFAULT_TRIGGER,
    available_now: bool = False,
    fmt: str = "parquet",
    name: str | None = None,
) -> StreamingQuery:
    """Start an append-mode streaming write to a path or a catalog table.

    ``available_now=True`` processes everything available and stops (tests,
    backfills); otherwise micro-batches run every ``trigger``.
    """
    w = df.writeStream.outputMode("append").format(fmt).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if partition_by:
        w = w.partitionBy(partition_by)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    if table is not None:
        return w.toTable(table)
    if path is None:
        raise ValueError("path or table is required")
    return w.start(path)


def bronze_starts(
    orderbook_raw: DataFrame,
    trades_raw: DataFrame,
    orderbook_out: str,
    trades_out: str,
    checkpoint_root: str,
    available_now: bool = False,
    trigger: str = DEFAULT_TRIGGER,
    fmt: str = "parquet",
) -> tuple[Callable[[], StreamingQuery], Callable[[], StreamingQuery]]:
    """Start functions of both bronze queries (order book, trades), each with its own checkpoint.

    An output is a folder, or the name of a catalog table (``bronze.trades``),
    which must exist (``plans.catalog.bootstrap``). ``fmt`` is the tables'
    format; only Parquet has the derived day column, others partition themselves.
    """
    root = checkpoint_root.rstrip("/")

    def of(frame: DataFrame, target: str, name: str) -> Callable[[], StreamingQuery]:
        by_day = fmt == "parquet"
        place = {"path": target} if "/" in target else {"table": target}
        return lambda: start_append(
            frame if by_day else frame.drop("ingest_time_date"),
            f"{root}/{name}",
            partition_by="ingest_time_date" if by_day else None,
            trigger=trigger,
            available_now=available_now,
            fmt=fmt,
            name=name,
            **place,
        )

    return (
        of(bronze_orderbook(orderbook_raw), orderbook_out, "bronze_orderbook_events"),
        of(bronze_trades(trades_raw), trades_out, "bronze_trades"),
    )


def start_bronze(*args, **options) -> tuple[StreamingQuery, StreamingQuery]:
    """Start both bronze queries; the arguments are those of ``bronze_starts``."""
    book, trades = bronze_starts(*args, **options)
    return book(), trades()


def await_any(spark: SparkSession, timeout: float | None = None) -> bool:
    """Block until any active query stops; a failure re-raises (both fail together)."""
    if timeout is None:
        spark.streams.awaitAnyTermination()
        return True
    return spark.streams.awaitAnyTermination(timeout)
