"""Bring raw, core and mart tables up to date for a range of hours.

Every table is computed once for the whole range; the hour is part of every
grouping, so one pass equals running the hours one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from hourmart import schemas
from hourmart.functions.timebuckets import Moment, as_hour, in_range
from hourmart.operators.neighbours import SPLIT_ROWS
from hourmart.plans import core, marts, raw
from hourmart.schemas import STAGING, TableSpec
from hourmart.sources.tables import (
    read_by_event_time,
    read_table,
    replace_hours,
    upsert_hours,
)

REPLACE = "replace"
UPSERT = "upsert"


@dataclass(frozen=True)
class Run:
    """The range being computed and how to read stored tables."""

    spark: SparkSession
    start: datetime
    end: datetime
    database: str
    split_rows: int

    def all(self, spec: TableSpec) -> DataFrame:
        return read_table(self.spark, spec, self.database)

    def part(self, spec: TableSpec) -> DataFrame:
        return read_table(self.spark, spec, self.database, self.start, self.end)

    def by_event(self, spec: TableSpec) -> DataFrame:
        """Staging rows that may belong to the range by their own time."""
        return read_by_event_time(self.spark, spec, self.database, self.start, self.end)

    def chain_inputs(self) -> tuple[DataFrame, dict]:
        browser = self.part(schemas.RAW_BROWSER)
        return browser, {"start": self.start, "end": self.end, "split_rows": self.split_rows}


@dataclass(frozen=True)
class FrameRun(Run):
    """The same over frames by table name; what is computed joins them."""

    frames: dict[str, DataFrame]

    def all(self, spec: TableSpec) -> DataFrame:
        return self.frames[spec.name]

    def by_event(self, spec: TableSpec) -> DataFrame:
        return self.frames[spec.name]

    def part(self, spec: TableSpec) -> DataFrame:
        return in_range(self.frames[spec.name], spec.hour, self.start, self.end)


def _raw_browser(run: Run) -> DataFrame:
    # By event time: the rows may be loaded in any hour, before or after.
    return raw.raw_browser_events(run.by_event(STAGING["browser_events"]), run.start, run.end)


def _buy_product(run: Run) -> DataFrame:
    browser, options = run.chain_inputs()
    location, device = run.all(schemas.RAW_LOCATION), run.all(schemas.RAW_DEVICE)
    return core.core_buy_product(browser, location, device, **options)


def _payment_confirm(run: Run) -> DataFrame:
    browser, options = run.chain_inputs()
    device, location = run.all(STAGING["device_events"]), run.all(STAGING["location_events"])
    return core.core_payment_confirm(browser, device, location, **options)


# In the order of what reads what.
STEPS: tuple[tuple[TableSpec, Callable[[Run], DataFrame]], ...] = (
    (schemas.RAW_BROWSER, _raw_browser),
    (schemas.RAW_DEVICE, lambda r: raw.raw_device_events(r.part(STAGING["device_events"]))),
    (schemas.RAW_GEO, lambda r: raw.raw_geo_events(r.part(STAGING["geo_events"]))),
    (schemas.RAW_LOCATION, lambda r: raw.raw_location_events(r.part(STAGING["location_events"]))),
    (schemas.CORE_BUY_PRODUCT, _buy_product),
    (schemas.CORE_PAYMENT, _payment_confirm),
    (schemas.DM_BUY_PRODUCT, lambda r: marts.dm_buy_product(r.part(schemas.CORE_BUY_PRODUCT))),
    (schemas.DM_TOP10_PAGE, lambda r: marts.dm_top10_page(r.part(schemas.CORE_BUY_PRODUCT))),
    (
        schemas.DM_HOURLY_EVENTS,
        lambda r: marts.dm_hourly_events(r.by_event(STAGING["browser_events"]), r.start, r.end),
    ),
    (
        schemas.DM_DIST_EVENTS,
        lambda r: marts.dm_dist_events(
            r.part(schemas.CORE_BUY_PRODUCT), r.part(schemas.CORE_PAYMENT)
        ),
    ),
)
TABLES: tuple[str, ...] = tuple(spec.name for spec, _ in STEPS)


def computed(
    spark: SparkSession,
    staging: dict[str, DataFrame],
    start: Moment,
    end: Moment,
    split_rows: int = SPLIT_ROWS,
) -> dict[str, DataFrame]:
    """All tables of ``[start, end)`` from staging frames, without storing any."""
    frames = {STAGING[feed].name: rows for feed, rows in staging.items()}
    run = FrameRun(spark, as_hour(start), as_hour(end), "", split_rows, frames)
    for spec, build in STEPS:
        frames[spec.name] = build(run).select(*spec.names)
    return frames


def backfill(
    spark: SparkSession,
    start: Moment,
    end: Moment,
    database: str = "default",
    marts_mode: str = REPLACE,
    tables: Iterable[str] = TABLES,
    split_rows: int = SPLIT_ROWS,
) -> None:
    """Compute the given tables (all by default) over ``[start, end)``.

    Raw tables and purchase core replace the hours. Payment core and marts do so
    too, or, with ``marts_mode="upsert"``, update by key and leave stale keys.
    """
    if marts_mode not in (REPLACE, UPSERT):
        raise ValueError(f"marts_mode must be {REPLACE} or {UPSERT}: {marts_mode}")
    wanted = set(tables)
    if unknown := wanted - set(TABLES):
        raise ValueError(f"unknown tables: {', '.join(sorted(unknown))}")
    run = Run(spark, as_hour(start), as_hour(end), database, split_rows)
    if run.end - run.start < timedelta(hours=1):
        raise ValueError(f"empty range: {run.start} to {run.end}")
    for spec, build in STEPS:
        if spec.name in wanted:
            by_key = bool(spec.key) and marts_mode == UPSERT
            write = upsert_hours if by_key else replace_hours
            write(spark, build(run), spec, run.start, run.end, database)
