"""Layer runs over a Parquet lake: bronze -> silver (incremental upsert) -> gold (rebuild).

Run order follows the model graph: silver levels before top of book,
silver trades before bars. Silver and gold are versioned tables: each step
publishes its rows and its high-water mark as one version, so a step that dies
leaves nothing behind, also in the first load. Each silver run reads only bronze
rows newer than its mark (first run: everything) and upserts them; running it
again on unchanged bronze adds nothing. ``run_all`` holds the lake's lease: a
second run at the same time is refused.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapehouse.operators import gold, silver
from tapehouse.schemas import LEVEL_KEYS, SILVER_TRADES_COLUMNS
from tapehouse.sources.lease import SECONDS, Lease
from tapehouse.sources.tables import UpsertResult, path_exists, upsert_parquet
from tapehouse.sources.versions import Table, Version


@dataclass(frozen=True)
class Lake:
    root: str

    def _p(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def table_path(self, table: str) -> str:
        """Folder of a layer table by its name, such as ``silver.stg_trades``."""
        return self._p(*table.split("."))

    @property
    def bronze_orderbook(self) -> str:
        return self._p("bronze", "orderbook_events")

    @property
    def bronze_trades(self) -> str:
        return self._p("bronze", "trades")

    @property
    def silver_trades(self) -> str:
        return self._p("silver", "stg_trades")

    @property
    def silver_levels(self) -> str:
        return self._p("silver", "stg_orderbook_levels")

    @property
    def gold_ohlcv(self) -> str:
        return self._p("gold", "gold_ohlcv_1min")

    @property
    def gold_top_of_book(self) -> str:
        return self._p("gold", "gold_top_of_book")


HWM, INGEST_HWM, BUILT = "hwm", "hwm_ingest", "built"
#: Columns by which silver trades are laid in files, so that a scan of products and times opens few.
TRADE_CLUSTER = ("product_id", "time")
Before = Callable[[], None] | None


def _micros(column: str):
    """A timestamp as microseconds, which do not depend on the session's time zone."""
    return F.unix_micros(F.col(column).cast("timestamp"))


def _bounded(bronze: DataFrame, bound: int | None) -> DataFrame:
    """Bronze rows ingested after ``bound`` (day partitions before it pruned)."""
    if bound is None:
        return bronze
    lit = F.timestamp_micros(F.lit(bound)).cast(bronze.schema["ingest_time"].dataType)
    out = bronze.where(F.col("ingest_time") > lit)
    if "ingest_time_date" in bronze.columns:
        out = out.where(F.col("ingest_time_date") >= F.to_date(lit))
    return out


def _mark(version: Version | None, name: str):
    return None if version is None else version.marks.get(name)


def newest_mark(column: str, old: int | None) -> Callable[[DataFrame], dict]:
    """The mark of a commit: the old one or the batch's, if larger."""

    def marks(rows: DataFrame) -> dict:
        found = [x for x in (old, rows.agg(F.max(_micros(column))).first()[0]) if x is not None]
        return {HWM: max(found)} if found else {}

    return marks


def silver_trades_step(spark: SparkSession, lake: Lake, before: Before = None) -> UpsertResult:
    """Incremental silver trades; partitioned by trade day (``time_date``).

    Reads bronze rows ingested after the committed high-water mark
    (``max(ingest_time)`` of silver), de-duplicates and upserts them. Returns
    the merged row count and the trade days touched (``None`` on the first
    run, which writes everything). ``before`` is called before anything is
    published.
    """
    bronze = spark.read.parquet(lake.bronze_trades)
    bound = _mark(Table(spark, lake.silver_trades).current(), HWM)
    src = silver.clean_trades(_bounded(bronze, bound)).withColumn("time_date", F.to_date("time"))
    return upsert_parquet(
        spark, lake.silver_trades, src, ["trade_id"], "time_date",
        marks=newest_mark("ingest_time", bound), cluster_by=TRADE_CLUSTER, before=before,
    )


def run_silver_trades(spark: SparkSession, lake: Lake) -> int:
    return silver_trades_step(spark, lake).rows


def run_silver_levels(
    spark: SparkSession,
    lake: Lake,
    snapshot_time: str = "ingest",
    newer_by: list[str] | None = None,
    reset_on_snapshot: bool = False,
    watermark: str = "event_time",
    before: Before = None,
) -> int:
    """Incremental silver order-book levels; partitioned by product.

    The default bound is the source system's: ingest times against the
    levels' largest event time, so an exchange clock that runs ahead skips
    messages. ``watermark="ingest_time"`` compares ingest times alone: the
    largest one of a run's messages is published with its rows.

    ``newer_by=["event_time", "sequence"]`` keeps a stored level when an
    arriving one is older (the default replaces unconditionally).
    ``reset_on_snapshot=True`` drops what arrived before the newest snapshot
    of a product: messages of this run, and all its stored levels.
    """
    bronze = spark.read.parquet(lake.bronze_orderbook)
    table = Table(spark, lake.silver_levels)
    base = table.current()
    by_ingest = watermark == "ingest_time"
    bound = _mark(base, INGEST_HWM if by_ingest else HWM)
    inc = _bounded(bronze, bound)
    marks = newest_mark("event_time", bound)
    if by_ingest:
        newest = inc.agg(F.max(_micros("ingest_time"))).first()[0]
        if newest is not None:  # messages that arrive meanwhile are the next run's
            until = F.timestamp_micros(F.lit(newest)).cast(bronze.schema["ingest_time"].dataType)
            inc = inc.where(F.col("ingest_time") <= until)

        def marks(rows: DataFrame) -> dict:
            return {} if newest is None else {INGEST_HWM: newest}

    prior = snaps = None
    if reset_on_snapshot:
        snaps = inc.where(F.col("type") == "snapshot").select("product_id").distinct()

        def prior(stored: DataFrame) -> DataFrame:
            """Stored levels arrived before any snapshot of this run; also of one without levels."""
            seen = snaps.withColumnRenamed("product_id", "_product")
            return stored.join(seen, F.col("product_id").eqNullSafe(F.col("_product")), "left_anti")

    src = silver.silver_levels(inc, None, snapshot_time=snapshot_time, reset_on_snapshot=reset_on_snapshot)
    res = upsert_parquet(
        spark, lake.silver_levels, src, LEVEL_KEYS, "product_id",
        newer_by=newer_by, prior=prior, also_touched=snaps, marks=marks, before=before,
    )
    if by_ingest and newest is not None and _mark(res.version, INGEST_HWM) != newest:
        table.set_marks(res.version, {INGEST_HWM: newest})  # messages without levels
    return res.rows


def run_gold(spark: SparkSession, lake: Lake, full: bool = False, before: Before = None) -> None:
    """Gold from silver, of the tables that are there: top of book rebuilt (one row per
    product); bars rebuilt in full (``full=True`` or the first run), or only for
    the trade days whose silver folder is not the one that gold was built from.

    Bars are partitioned by ``bucket_date``. A 1-minute bar depends only on
    the trades of its own day, so recomputing the changed days and replacing
    just those gold partitions gives the same table as a full rebuild, at the
    cost of the new days instead of the whole history. Which folders a version
    was built from is published with it, so a run that dies loses no day.
    """
    levels = Table(spark, lake.silver_levels)
    if levels.current() is not None:
        top = Table(spark, lake.gold_top_of_book)
        top.write(gold.top_of_book(levels.read()), base=top.current(), marks=_then(before))
    trades, bars = Table(spark, lake.silver_trades), Table(spark, lake.gold_ohlcv)
    stored = trades.current()
    if stored is None:
        return
    base = bars.current()
    built = {} if full else _mark(base, BUILT) or {}
    days = [d for d in {**built, **stored.folders} if built.get(d) != stored.folders.get(d)]
    if base is not None and not days and not full:
        return
    src = trades.read(stored, None if full or base is None else days).select(*SILVER_TRADES_COLUMNS)
    made = gold.ohlcv(src, "1 minute").withColumn("bucket_date", F.to_date("bucket"))
    replaced = None if full or base is None else [d.replace("time_date=", "bucket_date=", 1) for d in days]
    bars.write(made, "bucket_date", base, replaced, _then(before, {BUILT: stored.folders}))


def _then(before: Before, marks: dict | None = None) -> Callable[[DataFrame], dict]:
    def run(_: DataFrame) -> dict:
        if before:
            before()
        return marks or {}

    return run


def run_all(
    spark: SparkSession, lake: Lake, full_gold: bool = False, lease_seconds: float = SECONDS, keep_versions: int = 10,
    **levels,
) -> dict[str, int]:
    """Silver (levels, trades) then gold, in dependency order; ``full_gold`` rebuilds all bars.

    Of bronze, either table may be absent. ``levels`` are options of
    ``run_silver_levels``. Raises ``Busy`` while another run holds the lake.
    Versions before the last ``keep_versions`` are deleted at the end.
    """
    counts = {}
    with Lease(spark, lake.root, lease_seconds) as lease:
        if path_exists(spark, lake.bronze_orderbook):
            counts["silver_levels"] = run_silver_levels(spark, lake, before=lease.check, **levels)
        if path_exists(spark, lake.bronze_trades):
            counts["silver_trades"] = silver_trades_step(spark, lake, before=lease.check).rows
        run_gold(spark, lake, full=full_gold, before=lease.check)
        for path in (lake.silver_levels, lake.silver_trades, lake.gold_top_of_book, lake.gold_ohlcv):
            Table(spark, path).vacuum(keep_versions)
    return counts
