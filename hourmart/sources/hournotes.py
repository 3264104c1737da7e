"""Notes on the hours that staging writes touch.

A browser event may be loaded in any hour, so a run by event time would have to look into every
load hour. Two side tables, written with every staging write, spare that:

- ``staged_event_hours``: pairs of load hour and event hour, by event day. A run reads the load
  hours that the pairs of its own days name, and no others.
- ``changed_hours``: what a refresh has to compute again: event hours of browser events, the ones
  that were there before the write too, and load hours of the other feeds.

Pairs are only ever added, so a load hour written again at worst is read in vain. Before its rows
appear a load hour is announced under ``any`` day, which every run reads; this is withdrawn when
its pairs are noted. So at no moment, and after no failure, does a run miss rows. Rows whose time
cannot be read keep their load hour under ``any``.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmart.functions.timebuckets import bucket, moment_literal
from hourmart.schemas import EVENT_TIME_INDEX, TableSpec
from hourmart.sources.partitions import HOUR, in_runs

PAIRS = "staged_event_hours"
CHANGES = "changed_hours"
ANY = "any"
BY_EVENT = "browser_events"
# A run over more days reads all load hours: most are its own.
DAYS = 400
_TABLES = {
    PAIRS: "load_hour TIMESTAMP_NTZ, event_hour TIMESTAMP_NTZ, day STRING, batch STRING",
    CHANGES: "feed STRING, hour TIMESTAMP_NTZ, batch STRING",
}
_PARTITIONS = {PAIRS: ("day", "batch"), CHANGES: ("batch",)}


@dataclass(frozen=True)
class Notes:
    """One write: its number and its load hours."""

    batch: str
    hours: list[datetime]


def _table(spark: SparkSession, table: str, database: str) -> str:
    name = f"{database}.{table}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_TABLES[table]}) "
        f"USING parquet PARTITIONED BY ({', '.join(_PARTITIONS[table])})"
    )
    return name


def _append(spark: SparkSession, rows: DataFrame, table: str, database: str) -> None:
    name = _table(spark, table, database)
    columns = spark.table(name).columns
    rows.select(*columns).coalesce(1).write.insertInto(name, overwrite=False)


def load_hours(placed: DataFrame) -> list[datetime]:
    """The load hours of rows that have their partition columns."""
    hour = F.make_timestamp_ntz(
        F.year("dt"), F.month("dt"), F.day("dt"), F.col("hr"), F.lit(0), F.lit(0)
    )
    return sorted(row[0] for row in placed.select(hour).distinct().dropna().collect())


def _event_hours(spark: SparkSession, spec: TableSpec, database: str, hours) -> DataFrame:
    """Distinct pairs of the stored rows of some load hours; the typed time is all that is read."""
    stored = spark.table(f"{database}.{spec.name}").filter(in_runs(hours))
    load = F.make_timestamp_ntz(
        F.year("dt"), F.month("dt"), F.day("dt"), F.col("hr"), F.lit(0), F.lit(0)
    )
    known = stored.select(
        load.alias("load_hour"), bucket(EVENT_TIME_INDEX).alias("event_hour")
    ).distinct()
    lost = stored.filter(F.col(EVENT_TIME_INDEX).isNull()).select(load.alias("load_hour")).distinct()
    return known.unionByName(lost, allowMissingColumns=True)


def _changed(spark: SparkSession, spec: TableSpec, database: str, notes: Notes) -> DataFrame:
    pairs = _event_hours(spark, spec, database, notes.hours)
    hours = pairs.select(F.col("event_hour").alias("hour")).dropna().distinct()
    return hours.withColumns({"feed": F.lit(spec.name), "batch": F.lit(notes.batch)})


def announce(
    spark: SparkSession, spec: TableSpec, database: str, hours: list[datetime]
) -> Notes | None:
    """Before a write: its load hours, and the event hours that lose rows by it."""
    if not hours:
        return None
    notes = Notes(uuid.uuid4().hex, hours)
    if spec.name != BY_EVENT:
        rows = [(spec.name, hour, notes.batch) for hour in hours]
        _append(spark, spark.createDataFrame(rows, _TABLES[CHANGES]), CHANGES, database)
        return notes
    if not spark.catalog.tableExists(f"{database}.{PAIRS}"):
        _note_what_is_there(spark, spec, database)
    rows = [(hour, None, ANY, notes.batch) for hour in hours]
    _append(spark, spark.createDataFrame(rows, _TABLES[PAIRS]), PAIRS, database)
    _append(spark, _changed(spark, spec, database, notes), CHANGES, database)
    return notes


def note(spark: SparkSession, spec: TableSpec, database: str, notes: Notes) -> None:
    """After a write: the event hours that it holds; the announcement goes."""
    if spec.name != BY_EVENT:
        return
    _append(spark, _changed(spark, spec, database, notes), CHANGES, database)
    unread = _note_pairs(spark, spec, database, notes)
    settled = set(notes.hours) - unread
    announced = _pairs(spark, database).filter(F.col("day") == ANY).groupBy("batch")
    # One row an unfinished write, or one with unreadable times.
    for row in announced.agg(F.collect_set("load_hour").alias("hours")).collect():
        if set(row["hours"]) <= settled:
            spark.sql(
                f"ALTER TABLE {database}.{PAIRS} DROP IF EXISTS "
                f"PARTITION (day = '{ANY}', batch = '{row['batch']}')"
            )


def _pairs(spark: SparkSession, database: str) -> DataFrame:
    return spark.table(f"{database}.{PAIRS}")


def _note_pairs(
    spark: SparkSession, spec: TableSpec, database: str, notes: Notes
) -> set[datetime]:
    """Store the pairs of a write; returns the load hours with unreadable times."""
    day = F.coalesce(F.date_format("event_hour", "yyyy-MM-dd"), F.lit(ANY))
    pairs = _event_hours(spark, spec, database, notes.hours).withColumns(
        {"day": day, "batch": F.lit(notes.batch)}
    )
    _append(spark, pairs.filter(F.col("day") != ANY), PAIRS, database)
    lost = pairs.filter(F.col("day") == ANY).select("load_hour").distinct()
    return {row[0] for row in lost.collect()}


def _note_what_is_there(spark: SparkSession, spec: TableSpec, database: str) -> None:
    """Rows from before there were notes: all load hours get their pairs first."""
    hours = load_hours(spark.table(f"{database}.{spec.name}").select("dt", "hr"))
    if not hours:
        return
    notes = Notes(uuid.uuid4().hex, hours)
    day = F.coalesce(F.date_format("event_hour", "yyyy-MM-dd"), F.lit(ANY))
    pairs = _event_hours(spark, spec, database, hours)
    _append(
        spark, pairs.withColumns({"day": day, "batch": F.lit(notes.batch)}), PAIRS, database
    )


def load_hours_of_events(
    spark: SparkSession, database: str, start: datetime, end: datetime
) -> list[datetime] | None:
    """The load hours that may hold events of ``[start, end)``; none known: ``None``.

    Reads the notes of the range's own days and the announcements.
    """
    days = (end - HOUR).date() - start.date()
    if days > timedelta(days=DAYS) or not spark.catalog.tableExists(f"{database}.{PAIRS}"):
        return None
    hour = F.col("event_hour")
    own = F.col("day").between(f"{start:%Y-%m-%d}", f"{end - HOUR:%Y-%m-%d}")
    own &= (hour >= moment_literal(start)) & (hour < moment_literal(end))
    found = _pairs(spark, database).filter(own | (F.col("day") == ANY))
    return sorted(row[0] for row in found.select("load_hour").distinct().collect())


def pending(spark: SparkSession, database: str) -> tuple[list[str], DataFrame]:
    """The batches of changes that are there now, and their distinct (feed, hour)."""
    changes = spark.table(_table(spark, CHANGES, database))
    listed = spark.sql(f"SHOW PARTITIONS {database}.{CHANGES}").collect()
    batches = [row[0].partition("=")[2] for row in listed]
    return batches, changes.filter(F.col("batch").isin(batches)).select("feed", "hour").distinct()


def settle(spark: SparkSession, database: str, batches: list[str]) -> None:
    """Changes that have been followed go; ones noted since stay."""
    if batches:
        clauses = ", ".join(f"PARTITION (batch = '{batch}')" for batch in batches)
        spark.sql(f"ALTER TABLE {database}.{CHANGES} DROP IF EXISTS {clauses}")
