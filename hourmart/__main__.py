"""``spark-submit`` entry: land feeds, bring tables up to date, report readiness."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import timedelta

from hourmart.functions.timebuckets import as_hour
from hourmart.plans.backfill import REPLACE, TABLES, UPSERT, backfill
from hourmart.plans.readiness import stored_hours_ready
from hourmart.plans.refresh import refresh
from hourmart.schemas import FEEDS
from hourmart.session import build_session
from hourmart.sources.landing import load_changed, load_feed
from hourmart.streaming.landing import land_incremental


def _arguments(given: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="hourmart", description=__doc__)
    parser.add_argument("--database", default="default")
    jobs = parser.add_subparsers(dest="job", required=True)

    land = jobs.add_parser("land", help="objects of a range to staging")
    land.add_argument("root")
    land.add_argument("--feeds", nargs="+", choices=FEEDS, default=FEEDS)
    land.add_argument("--start")
    land.add_argument("--end")

    changed = jobs.add_parser("land-changed", help="objects that are new or have been replaced")
    changed.add_argument("root")
    changed.add_argument("--feeds", nargs="+", choices=FEEDS, default=FEEDS)
    changed.add_argument("--start")
    changed.add_argument("--end")

    follow = jobs.add_parser("land-new", help="objects not seen before to staging")
    follow.add_argument("root")
    follow.add_argument("checkpoint")
    follow.add_argument("--feeds", nargs="+", choices=FEEDS, default=FEEDS)

    fill = jobs.add_parser("backfill", help="raw, core and marts of a range")
    fill.add_argument("start")
    fill.add_argument("end")
    fill.add_argument("--tables", nargs="+", choices=TABLES, default=TABLES)
    fill.add_argument("--marts-mode", choices=(REPLACE, UPSERT), default=REPLACE)

    again = jobs.add_parser("refresh", help="whatever landings have touched since the last one")
    again.add_argument("--marts-mode", choices=(REPLACE, UPSERT), default=REPLACE)
    again.add_argument("--reach", type=int, help="hours between an event and its page or device")

    ready = jobs.add_parser("ready", help="rows per hour and feed")
    ready.add_argument("start")
    ready.add_argument("end")
    return parser.parse_args(given)


def main(given: Sequence[str] | None = None) -> None:
    args = _arguments(given)
    spark = build_session()
    if args.job == "land":
        for feed in args.feeds:
            load_feed(spark, args.root, feed, args.start, args.end, args.database)
    elif args.job == "land-changed":
        for feed in args.feeds:
            found = load_changed(spark, args.root, feed, args.start, args.end, args.database)
            print(f"{feed}: {found} objects")
    elif args.job == "land-new":
        for feed in args.feeds:
            place = f"{args.checkpoint}/{feed}"
            land_incremental(spark, args.root, feed, place, args.database).awaitTermination()
    elif args.job == "backfill":
        backfill(spark, args.start, args.end, args.database, args.marts_mode, args.tables)
    elif args.job == "refresh":
        hours = refresh(spark, args.database, args.marts_mode, reach=args.reach)
        print(f"{len(hours)} hours")
    else:
        hours = (as_hour(args.end) - as_hour(args.start)) // timedelta(hours=1)
        report = stored_hours_ready(spark, args.start, args.end, args.database).orderBy("load_hour")
        report.show(hours, truncate=False)


if __name__ == "__main__":
    main()
