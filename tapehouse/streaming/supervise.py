"""A group of streams that fail together, start again from their checkpoints, and log their progress."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

PROGRESS_DDL = (
    "query string, run string, batch bigint, at string, input_rows bigint, metric string, value bigint"
)


@dataclass(frozen=True)
class Restarts:
    """How often a group may start again: ``most`` times, counted anew after ``healthy`` seconds
    without a failure; the wait before a start doubles from ``wait`` up to ``longest``."""

    most: int = 5
    wait: float = 1.0
    longest: float = 60.0
    healthy: float = 600.0


class ProgressLog:
    """Appends every micro-batch's counts to a Parquet table, one row a metric.

    A batch is logged once while this object lives; the metrics are those of
    ``observe`` (such as ``bronze_trades_feed.messages``), and a row without a
    metric for the batch itself. A batch that failed has that row alone; it comes
    again under another run.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.seen: dict[str, int] = {}

    def poll(self, queries: Sequence[StreamingQuery]) -> int:
        """Log the batches that have ended since the last call; returns their number."""
        rows, batches = [], 0
        for q in queries:
            for p in q.recentProgress:
                said = p if isinstance(p, dict) else json.loads(p.json)
                run, batch = str(said["runId"]), int(said["batchId"])
                if batch <= self.seen.get(run, -1):
                    continue
                self.seen[run] = batch
                batches += 1
                base = (said.get("name"), run, batch, said["timestamp"], int(said.get("numInputRows") or 0))
                rows.append((*base, None, None))
                for name, values in (said.get("observedMetrics") or {}).items():
                    values = values if isinstance(values, dict) else values.asDict()
                    rows += [(*base, f"{name}.{k}", None if v is None else int(v)) for k, v in values.items()]
        if rows:
            self.spark.createDataFrame(rows, PROGRESS_DDL).coalesce(1).write.mode("append").parquet(self.path)
        return batches


def run_group(
    spark: SparkSession,
    starts: Sequence[Callable[[], StreamingQuery]],
    restarts: Restarts = Restarts(),
    progress: ProgressLog | None = None,
    poll: float = 1.0,
    until: Callable[[], bool] | None = None,
) -> int:
    """Start all streams and watch them; returns the number of restarts.

    When one fails the others are stopped, and all start again from their
    checkpoints. When ``restarts`` are used up the failure is raised. Ends
    when all streams have ended by themselves, or all are stopped because
    ``until()`` holds.
    """
    failed, wait, started = 0, restarts.wait, 0
    while True:
        queries: list[StreamingQuery] = []
        began, failure = time.monotonic(), None
        try:
            for start in starts:
                queries.append(start())
            while failure is None:
                running = [q for q in queries if q.isActive]
                if progress:
                    progress.poll(queries)
                failure = next((e for q in queries if not q.isActive and (e := q.exception())), None)
                if failure is None and (not running or (until and until())):
                    return started
                if failure is None:
                    running[0].awaitTermination(poll)
        except StreamingQueryException as e:  # of the one that was waited for
            failure = e
        finally:
            for q in queries:
                if q.isActive:
                    q.stop()
            if progress:
                progress.poll(queries)
        if time.monotonic() - began >= restarts.healthy:
            failed, wait = 0, restarts.wait
        failed += 1
        if failed > restarts.most:
            raise failure
        time.sleep(wait)
        wait = min(2 * wait, restarts.longest)
        started += 1
