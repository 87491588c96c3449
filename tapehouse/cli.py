"""Command line: the two jobs of the stack.

  python -m tapehouse bronze --lake ROOT --checkpoints DIR (--kafka HOST:PORT | --book-files DIR --trade-files DIR)
                             [--available-now] [--trigger "10 seconds"] [--tables]
                             [--restarts 5] [--progress DIR]
  python -m tapehouse layers --lake ROOT [--reset-on-snapshot] [--guard-late-levels]
                             [--ingest-watermark] [--full-gold] [--tables]
                             [--lease-seconds 600] [--keep-versions 10]

With ``--tables`` the namespaces and tables of all layers are created first where
they are missing, and are catalog tables over the lake's folders.
``bronze`` runs both ingest streams: when one fails the other is stopped and
both start again from their checkpoints, ``--restarts`` times at most. ``layers`` runs silver then gold once; run it
on a schedule (the source system refreshes every 10 minutes). While a run holds
the lake's lease another one is refused.
"""

from __future__ import annotations

import argparse
import json

from tapehouse.plans.catalog import bootstrap, sync
from tapehouse.plans.layers import Lake, run_all
from tapehouse.schemas import ORDERBOOK_TOPIC, TRADES_TOPIC
from tapehouse.session import build_session
from tapehouse.sources.feed import file_stream, kafka_stream
from tapehouse.streaming.bronze import bronze_starts
from tapehouse.streaming.supervise import ProgressLog, Restarts, run_group


def _bronze(args: argparse.Namespace) -> None:
    spark = build_session("tapehouse-bronze")
    if args.kafka:
        book = kafka_stream(spark, ORDERBOOK_TOPIC, args.kafka)
        trades = kafka_stream(spark, TRADES_TOPIC, args.kafka)
    else:
        book = file_stream(spark, args.book_files)
        trades = file_stream(spark, args.trade_files)
    lake = Lake(args.lake)
    out = (lake.bronze_orderbook, lake.bronze_trades)
    if args.tables:
        bootstrap(spark, lake)
        out = ("bronze.orderbook_events", "bronze.trades")
    starts = bronze_starts(book, trades, *out, args.checkpoints, available_now=args.available_now, trigger=args.trigger)
    log = ProgressLog(spark, args.progress) if args.progress else None
    run_group(spark, starts, Restarts(most=args.restarts), log)


def _layers(args: argparse.Namespace) -> None:
    spark = build_session("tapehouse-layers")
    lake = Lake(args.lake)
    if args.tables:
        bootstrap(spark, lake)
    counts = run_all(
        spark, lake, full_gold=args.full_gold, lease_seconds=args.lease_seconds, keep_versions=args.keep_versions,
        newer_by=["event_time", "sequence"] if args.guard_late_levels else None,
        reset_on_snapshot=args.reset_on_snapshot,
        watermark="ingest_time" if args.ingest_watermark else "event_time",
    )
    if args.tables:
        sync(spark, lake)
    print(json.dumps(counts))


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="tapehouse")
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("bronze", help="start the two bronze ingest streams")
    b.add_argument("--lake", required=True)
    b.add_argument("--checkpoints", required=True)
    b.add_argument("--kafka", help="bootstrap servers; otherwise JSON-lines folders")
    b.add_argument("--book-files")
    b.add_argument("--trade-files")
    b.add_argument("--available-now", action="store_true")
    b.add_argument("--trigger", default="10 seconds")
    b.add_argument("--tables", action="store_true", help="create the tables and append to them")
    b.add_argument("--restarts", type=int, default=5, help="how often the streams may start again after a failure")
    b.add_argument("--progress", help="folder of a Parquet table that gets the counts of every micro-batch")
    b.set_defaults(fn=_bronze)
    la = sub.add_parser("layers", help="refresh silver (incremental) and gold (rebuild) once")
    la.add_argument("--lake", required=True)
    la.add_argument("--reset-on-snapshot", action="store_true")
    la.add_argument("--guard-late-levels", action="store_true")
    la.add_argument("--ingest-watermark", action="store_true", help="bound the levels' increments by ingest time alone")
    la.add_argument("--full-gold", action="store_true", help="rebuild all bars, not only those of touched days")
    la.add_argument("--tables", action="store_true", help="create the tables and keep their partitions up to date")
    la.add_argument("--lease-seconds", type=float, default=600.0, help="after this time a dead run's lease can be taken")
    la.add_argument("--keep-versions", type=int, default=10, help="versions of each table to keep for readers")
    la.set_defaults(fn=_layers)
    args = p.parse_args(argv)
    if args.cmd == "bronze" and not args.kafka and not (args.book_files and args.trade_files):
        p.error("bronze needs --kafka or both --book-files and --trade-files")
    args.fn(args)


if __name__ == "__main__":
    main()
