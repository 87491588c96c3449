"""Silver that follows bronze batch by batch, each batch one transaction.

The number of a stream's micro-batch is published in the silver table's
manifest with the batch's rows. A batch that comes again, because the stream
died between the publication and its own checkpoint, finds its number there and
changes nothing; no high-water mark is read from the rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapehouse.operators import silver
from tapehouse.plans.layers import HWM, TRADE_CLUSTER, Lake, newest_mark
from tapehouse.schemas import LEVEL_KEYS
from tapehouse.sources.tables import upsert_parquet
from tapehouse.sources.versions import Table
from tapehouse.streaming.bronze import DEFAULT_TRIGGER

Step = Callable[[DataFrame, int], bool]


def _once(path: Callable[[Lake], str], rows: Callable[[DataFrame], DataFrame], clock: str, **merge) -> Callable[..., Step]:
    def of(lake: Lake, stream: str) -> Step:
        name = f"batch:{stream}"

        def step(batch: DataFrame, batch_id: int) -> bool:
            """Merge one micro-batch; False if it had been merged before."""
            table = Table(batch.sparkSession, path(lake))
            base = table.current()
            marks = {} if base is None else base.marks
            if marks.get(name, -1) >= batch_id:
                return False
            newest = newest_mark(clock, marks.get(HWM))
            res = upsert_parquet(
                batch.sparkSession, path(lake), rows(batch), marks=lambda src: newest(src) | {name: batch_id}, **merge
            )
            if res.version.marks.get(name) != batch_id:  # nothing to merge: the number alone
                table.set_marks(res.version, {name: batch_id})
            return True

        return step

    return of


#: One micro-batch of bronze trades, or of order-book messages, into silver: (lake, stream name) -> (batch, its number).
trades_batch = _once(
    lambda lake: lake.silver_trades, lambda b: silver.clean_trades(b).withColumn("time_date", F.to_date("time")),
    "ingest_time", keys=["trade_id"], partition_col="time_date", cluster_by=TRADE_CLUSTER,
)
levels_batch = _once(lambda lake: lake.silver_levels, silver.silver_levels, "event_time", keys=LEVEL_KEYS, partition_col="product_id")


def start_silver(
    bronze: DataFrame, step: Step, checkpoint: str, trigger: str = DEFAULT_TRIGGER, available_now: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Run ``step`` for every micro-batch of a stream over bronze (``foreachBatch``).

    Give each stream into one table its own name in ``trades_batch`` or
    ``levels_batch`` and its own checkpoint: a new checkpoint counts from 0
    again and needs a new name.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        step(batch, batch_id)

    w = bronze.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)).start()
