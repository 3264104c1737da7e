"""Bring tables up to date with whatever has landed, without a given range.

Every staging write notes the hours it touches (``sources.hournotes``). A refresh computes these
again and no others: raw tables of the touched load hours, and raw events, core tables and marts
of the touched event hours. A page or a device may land long after the events that name it, so
the hours of those events are touched, too.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmart import schemas
from hourmart.functions.timebuckets import bucket
from hourmart.operators.neighbours import SPLIT_ROWS
from hourmart.plans.backfill import REPLACE, backfill
from hourmart.sources import hournotes
from hourmart.sources.partitions import HOUR, in_runs, runs_of
from hourmart.sources.tables import ensure_table, read_table

# Hours between two runs that are computed along, as one run is one pass.
GAP = 24
RAW_OF: dict[str, schemas.TableSpec] = {
    spec.name.removeprefix("raw_"): spec for spec in schemas.RAW
}
# The column by which an event names rows of another feed.
NAMED_BY: dict[str, str] = {"device_events": "click_id", "location_events": "event_id"}
_DERIVED = tuple(spec.name for spec in (*schemas.CORE, *schemas.MARTS))


def _names(spark: SparkSession, feed: str, hours: list[datetime], database: str) -> DataFrame:
    """Keys of a feed's rows of some load hours: as staged, and as raw has them so far."""
    key = NAMED_BY[feed]
    parts = [
        spark.table(ensure_table(spark, spec, database)).filter(in_runs(hours)).select(key)
        for spec in (schemas.STAGING[feed], RAW_OF[feed])
    ]
    return reduce(DataFrame.unionByName, parts).dropna().distinct()


def named_hours(
    spark: SparkSession,
    changed: dict[str, list[datetime]],
    database: str = "default",
    reach: int | None = None,
) -> list[datetime]:
    """Hours of the raw events that name rows of the changed load hours.

    Reads two columns of the raw events: of all, or of those up to ``reach`` hours around the
    changed load hours, where it is known that rows are never further from their events.
    """
    found = []
    for feed, key in NAMED_BY.items():
        hours = changed.get(feed)
        if not hours:
            continue
        bounds = () if reach is None else (min(hours) - reach * HOUR, max(hours) + (reach + 1) * HOUR)
        events = read_table(spark, schemas.RAW_BROWSER, database, *bounds)
        named = events.join(_names(spark, feed, hours, database), key, "left_semi")
        found.append(named.select(bucket("event_timestamp").alias("hour")))
    if not found:
        return []
    return [row[0] for row in reduce(DataFrame.unionByName, found).distinct().collect()]


def refresh(
    spark: SparkSession,
    database: str = "default",
    marts_mode: str = REPLACE,
    split_rows: int = SPLIT_ROWS,
    reach: int | None = None,
) -> list[datetime]:
    """Compute again what staging writes have touched since the last refresh; returns the event
    hours that were. A refresh that fails changes nothing in what is to be done."""
    batches, changes = hournotes.pending(spark, database)
    if not batches:
        return []
    changed: dict[str, list[datetime]] = {}
    for feed, hour in changes.collect():
        changed.setdefault(feed, []).append(hour)

    def fill(tables: tuple[str, ...], hours: list[datetime]) -> None:
        for first, end in runs_of(hours, GAP):
            backfill(spark, first, end, database, marts_mode, tables, split_rows)

    fill((schemas.RAW_BROWSER.name,), changed.get(hournotes.BY_EVENT, []))
    # Before raw rows that are no longer staged go: their events are touched as well.
    named = named_hours(spark, changed, database, reach)
    for feed, hours in changed.items():
        if feed != hournotes.BY_EVENT:
            fill((RAW_OF[feed].name,), hours)
    hours = sorted({*changed.get(hournotes.BY_EVENT, []), *named})
    fill(_DERIVED, hours)
    hournotes.settle(spark, database, batches)
    return hours
