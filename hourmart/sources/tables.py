"""Stored tables: Parquet, partitioned by day and hour.

A write overwrites exactly the partitions it holds rows for. Spark moves the new
files in when the whole job has succeeded, so a failed write, a broken contract
included, leaves the table as it was; reruns give the same table. No hour shares a
partition with another, so writers of different hours may run side by side. Writers of
the same hours take turns within an application. An upsert merges with the rows that it
read; if their files are others by the time it is to write, it reads and merges again.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime
from threading import Condition, Lock

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hourmart.functions.timebuckets import Moment, as_hour, in_range
from hourmart.operators.contracts import enforce, enforce_unique
from hourmart.operators.merge import inside, upsert
from hourmart.schemas import STAGING, TableSpec
from hourmart.sources import hournotes
from hourmart.sources.partitions import hours_between, in_runs

_PARTITION_TYPES = {"dt": "DATE", "hr": "INT"}
BUCKETS = "spark.hourmart.buckets"
# How often an upsert starts again when others have changed its hours.
ATTEMPTS = 20


def full_name(spec: TableSpec, database: str) -> str:
    return f"{database}.{spec.name}"


def ensure_table(spark: SparkSession, spec: TableSpec, database: str = "default") -> str:
    """Create the table if it is not there; returns its full name."""
    columns = [spec.columns]
    columns += [f"{name} {kind}" for name, kind, _ in spec.hidden]
    columns += [f"{name} {_PARTITION_TYPES[name]}" for name in spec.partitions]
    name = full_name(spec, database)
    number, bloom, buckets = _buckets(spark), "", ""
    if spec.clustered and number:
        bloom = f"OPTIONS ('parquet.bloom.filter.enabled#{spec.clustered}' = 'true') "
        key = f"({spec.clustered})"
        buckets = f" CLUSTERED BY {key} SORTED BY {key} INTO {number} BUCKETS"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) "
        f"USING parquet {bloom}PARTITIONED BY ({', '.join(spec.partitions)}){buckets}"
    )
    return name


def _buckets(spark: SparkSession) -> int:
    """Buckets of tables that others look up by key; none unless set, as each hour then has
    that many files. Aim at a bucket of an hour of some 100 MB."""
    return int(spark.conf.get(BUCKETS, "0"))


def _partition_columns(spec: TableSpec) -> dict[str, Column]:
    known = {"dt": F.to_date(spec.hour), "hr": F.hour(spec.hour)}
    return {name: known[name] for name in spec.partitions}


def read_table(
    spark: SparkSession,
    spec: TableSpec,
    database: str = "default",
    start: Moment | None = None,
    end: Moment | None = None,
) -> DataFrame:
    """The table's rows, or those of an hour range: whole partitions are skipped.

    Hidden columns come along at the end; partition columns do not.
    """
    rows = spark.table(ensure_table(spark, spec, database))
    if start is not None or end is not None:
        rows = in_range(rows.filter(hours_between(start, end)), spec.hour, start, end)
    return rows.drop(*spec.partitions)


def read_by_event_time(
    spark: SparkSession,
    spec: TableSpec,
    database: str = "default",
    start: Moment | None = None,
    end: Moment | None = None,
) -> DataFrame:
    """A staging table's load hours that may hold events of ``[start, end)``.

    Which these are is noted by every write; the rows still need the test of their own
    time. Without notes, or without bounds, it is the whole table.
    """
    rows = spark.table(ensure_table(spark, spec, database))
    if start is not None and end is not None:
        hours = hournotes.load_hours_of_events(spark, database, as_hour(start), as_hour(end))
        if hours is not None:
            rows = rows.filter(in_runs(hours))
    return rows.drop(*spec.partitions)


def _require_dynamic(spark: SparkSession) -> None:
    """Any other mode would overwrite the whole table."""
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
    if mode.lower() != "dynamic":
        raise RuntimeError("set spark.sql.sources.partitionOverwriteMode to dynamic to write")


class _WideWrites:
    """While any write runs, little data is no reason for few tasks: every hour costs a file,
    and one task would write them one after another. Writes may run side by side."""

    KEY, SIZE = "spark.sql.adaptive.coalescePartitions.minPartitionSize", "4KB"

    def __init__(self) -> None:
        self._lock, self._running, self._before = Lock(), 0, None

    @contextmanager
    def __call__(self, spark: SparkSession) -> Iterator[None]:
        with self._lock:
            if not self._running:
                self._before = spark.conf.get(self.KEY)
                spark.conf.set(self.KEY, self.SIZE)
            self._running += 1
        try:
            yield
        finally:
            with self._lock:
                self._running -= 1
                if not self._running:
                    spark.conf.set(self.KEY, self._before)


_WIDE = _WideWrites()


def overwrite_partitions(
    spark: SparkSession,
    rows: DataFrame,
    spec: TableSpec,
    database: str = "default",
    spread: bool = True,
    hours: list[datetime] | None = None,
) -> list[tuple]:
    """Replace the partitions the rows fall into; returns those partitions.

    Writes of staging tables are noted (``hournotes``); ``hours`` are the load hours of the
    rows, where they are known, else the rows are asked for them first.

    ``spread`` regroups rows by partition, so that an hour becomes few files,
    and a very large hour is shared by several tasks. The partitions are noted
    during the write: one entry an hour of the range.
    """
    _require_dynamic(spark)
    name = ensure_table(spark, spec, database)
    hidden = {column: F.expr(expression) for column, _, expression in spec.hidden}
    placed = rows.select(*spec.names).withColumns(hidden | _partition_columns(spec))
    notes = None
    if STAGING.get(spec.name) is spec:
        if hours is None:
            hours = hournotes.load_hours(placed)
        notes = hournotes.announce(spark, spec, database, hours)
    if spread:
        parts = list(spec.partitions)
        if spec.clustered and (number := _buckets(spark)):
            # The rows of a bucket to one task, so that it becomes one sorted file.
            parts.append("_bucket")
            bucket = F.pmod(F.hash(spec.clustered), F.lit(number))
            placed = placed.withColumn("_bucket", bucket)
        placed = placed.hint("rebalance", *[F.col(c) for c in parts]).drop("_bucket")
    # Noted last: above the shuffle it is still there when no row arrives.
    seen = Observation()
    noted = placed.observe(seen, F.collect_set(F.struct(*spec.partitions)).alias("partitions"))
    with _WIDE(spark):
        noted.write.insertInto(name, overwrite=True)
    if notes is not None:
        hournotes.note(spark, spec, database, notes)
    return [tuple(row) for row in seen.get["partitions"]]


def _partitions_in_range(
    spark: SparkSession, spec: TableSpec, database: str, start: Moment, end: Moment
) -> list[tuple]:
    listed = spark.sql(f"SHOW PARTITIONS {full_name(spec, database)}")
    values = [
        F.regexp_extract("partition", rf"(?:^|/){name}=([^/]+)", 1).cast(_PARTITION_TYPES[name])
        .alias(name)
        for name in spec.partitions
    ]
    return [tuple(row) for row in listed.select(*values).filter(hours_between(start, end)).collect()]


def _drop_partitions(
    spark: SparkSession, spec: TableSpec, database: str, partitions: list[tuple]
) -> None:
    if not partitions:
        return
    clauses = []
    for values in sorted(partitions):
        pairs = zip(spec.partitions, values)
        text = ", ".join(f"{n} = DATE'{v}'" if n == "dt" else f"{n} = {v}" for n, v in pairs)
        clauses.append(f"PARTITION ({text})")
    spark.sql(
        f"ALTER TABLE {full_name(spec, database)} DROP IF EXISTS {', '.join(clauses)}"
    )


class _Turns:
    """Writers of one application wait for those that hold some of their hours of a table."""

    def __init__(self) -> None:
        self._free, self._held = Condition(), []

    @contextmanager
    def __call__(self, table: str, start: datetime, end: datetime) -> Iterator[None]:
        own = (table, start, end)

        def free() -> bool:
            return not any(t == table and a < end and start < b for t, a, b in self._held)

        with self._free:
            self._free.wait_for(free)
            self._held.append(own)
        try:
            yield
        finally:
            with self._free:
                self._held.remove(own)
                self._free.notify_all()


_TURNS = _Turns()


def _checked(rows: DataFrame, spec: TableSpec, start: Moment, end: Moment) -> DataFrame:
    """The rows, with every rule of the table as a guard."""
    return enforce_unique(enforce(inside(rows, spec.hour, start, end, spec.name), spec), spec)


def _files(spark: SparkSession, spec: TableSpec, database: str, start: Moment, end: Moment) -> set:
    """The files that now hold the range; every write gives its files new names."""
    # A session of its own lists them anew and keeps what the others have cached.
    return set(read_table(spark.newSession(), spec, database, start, end).inputFiles())


def replace_hours(
    spark: SparkSession,
    rows: DataFrame,
    spec: TableSpec,
    start: Moment,
    end: Moment,
    database: str = "default",
) -> None:
    """Make ``[start, end)`` of the table equal to the rows; an hour without new
    rows ends up empty."""
    name = ensure_table(spark, spec, database)
    checked = _checked(rows, spec, start, end)
    with _TURNS(name, as_hour(start), as_hour(end)):
        written = overwrite_partitions(spark, checked, spec, database)
        stale = set(_partitions_in_range(spark, spec, database, start, end)) - set(written)
        _drop_partitions(spark, spec, database, list(stale))


def upsert_hours(
    spark: SparkSession,
    updates: DataFrame,
    spec: TableSpec,
    start: Moment,
    end: Moment,
    database: str = "default",
) -> None:
    """Update or insert by key within ``[start, end)``. Stored keys without an
    update stay, those of the same hour too. Only the touched hours are rewritten.

    The merge is computed before anyone has to wait for it. Should another writer have
    changed the range meanwhile, it is computed again from what is there now.
    """
    name = ensure_table(spark, spec, database)
    checked = _checked(updates, spec, start, end)
    for _ in range(ATTEMPTS):
        before = _files(spark, spec, database, start, end)
        spark.catalog.refreshTable(name)
        stored = read_table(spark, spec, database, start, end)
        merged = upsert(stored.select(*spec.names), checked, list(spec.key)).persist()
        try:
            merged.count()
            with _TURNS(name, as_hour(start), as_hour(end)):
                if _files(spark, spec, database, start, end) == before:
                    overwrite_partitions(spark, merged, spec, database)
                    return
        finally:
            merged.unpersist()
    raise RuntimeError(f"{name}: others kept changing {start} to {end} during {ATTEMPTS} attempts")
