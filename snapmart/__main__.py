"""Jobs for spark-submit.

    python -m snapmart [--buckets N] load   --landing DIR --lake DIR --progress DIR [--once]
    python -m snapmart [--buckets N] sync   --source DIR --lake DIR --batch NAME [--mode FULL|INCREMENTAL] [--by max_key|changed_since]
    python -m snapmart [--buckets N] report --lake DIR [--day YYYY-MM-DD]
"""

from __future__ import annotations

import argparse

from snapmart.operators.audit import audit_tail
from snapmart.plans import catalog, reports
from snapmart.plans.sync_job import ORDER, WAYS, sync_tables
from snapmart.roles import Tables
from snapmart.session import build_session
from snapmart.sources.lake import Lake, layout
from snapmart.streaming import jobs

POLL_EVERY = {"processingTime": "5 minutes"}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="snapmart")
    top.add_argument("--master", help="only for runs without spark-submit")
    top.add_argument("--buckets", type=int, default=64, help="buckets of the keyed tables, always the same for a lake")
    commands = top.add_subparsers(dest="command", required=True)

    load = commands.add_parser("load", help="load landing files as they arrive")
    load.add_argument("--landing", required=True)
    load.add_argument("--lake", required=True)
    load.add_argument("--progress", required=True, help="folder for the progress of the stream")
    load.add_argument("--top", type=int, default=100, help="entries taken from each ranking")
    load.add_argument("--collation", help="for instance es_CI_AI_RTRIM")
    load.add_argument("--once", action="store_true", help="load what is there and stop")

    sync = commands.add_parser("sync", help="bring one lake up to date with another")
    sync.add_argument("--source", required=True)
    sync.add_argument("--lake", required=True)
    sync.add_argument("--batch", required=True, help="name of this copy; give the same one to repeat it")
    sync.add_argument("--mode", default="INCREMENTAL")
    sync.add_argument("--by", default=WAYS[0], choices=WAYS)

    report = commands.add_parser("report", help="print the daily report")
    report.add_argument("--lake", required=True)
    report.add_argument("--day")
    return top


def stored_tables(lake: Lake) -> Tables:
    return Tables(**{s.table: lake.read(s.table) for s in ORDER})


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = build_session(master=args.master)
    lake = Lake(spark, args.lake, layout(args.buckets))
    if args.command == "load":
        query = jobs.stream_load(lake, args.landing, args.progress, jobs.ONCE if args.once else POLL_EVERY,
                                 top_n=args.top, collation=args.collation)
        query.awaitTermination()
    elif args.command == "sync":
        source = Lake(spark, args.source, layout(args.buckets))
        frames = {s.table: source.read(s.table) for s in ORDER}
        sync_tables(frames, lake, args.batch, args.mode, args.by).show(truncate=False)
    else:
        tables = stored_tables(lake)
        parts = reports.daily_report(tables, args.day)
        for part in (parts.summary, parts.top_now, parts.top_categories, parts.movers):
            part.show(truncate=False)
        catalog.top_categories(tables).show(truncate=False)
        audit_tail(lake.read("audit")).show(truncate=False)


if __name__ == "__main__":
    main()
