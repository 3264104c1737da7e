"""Time expressions. All instants are UTC and stored as TIMESTAMP_NTZ."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOUR = "hour"
DAY = "day"
GRAINS = (HOUR, DAY)

Moment = datetime | str


def as_hour(moment: Moment) -> datetime:
    """A range bound as a naive UTC datetime; it must fall on a whole hour."""
    value = datetime.fromisoformat(moment) if isinstance(moment, str) else moment
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    if value.minute or value.second or value.microsecond:
        raise ValueError(f"not a whole hour: {moment}")
    return value


def moment_literal(moment: Moment) -> Column:
    return F.lit(as_hour(moment).isoformat(sep=" ")).cast("timestamp_ntz")


def bucket(ts: Column | str, grain: str = HOUR) -> Column:
    """Start of the hour (or day) of a plain timestamp.

    A tumbling window is plain arithmetic on a plain timestamp, where truncation
    would go through the session's time zone and back for every row. Spark takes
    one window per select and drops rows without a time.
    """
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}: {grain}")
    return F.window(ts, f"1 {grain}")["start"]


def within(ts: Column, start: Moment | None, end: Moment | None) -> Column | None:
    """``start <= ts < end``. Bare comparisons on the column reach the scan."""
    condition = None
    if start is not None:
        condition = ts >= moment_literal(start)
    if end is not None:
        upper = ts < moment_literal(end)
        condition = upper if condition is None else condition & upper
    return condition


def in_range(
    rows: DataFrame, ts: Column | str, start: Moment | None, end: Moment | None
) -> DataFrame:
    """Rows of a half-open hour range; rows without a time are never in a range.

    With no bounds, only the rows without a time go: an hour run never sees them.
    """
    column = F.col(ts) if isinstance(ts, str) else ts
    condition = within(column, start, end)
    return rows.filter(column.isNotNull() if condition is None else condition)


def parse_timestamp(text: Column | str) -> Column:
    """Text to plain timestamp. A zone suffix is ignored, bad text is an error."""
    column = F.col(text) if isinstance(text, str) else text
    return column.cast("timestamp_ntz")


def plain_timestamp(rows: DataFrame, name: str) -> Column:
    """A zoned or plain timestamp column as a plain UTC one."""
    column = F.col(name)
    kind = rows.schema[name].dataType.typeName()
    if kind == "timestamp":
        return F.to_utc_timestamp(column, F.current_timezone()).cast("timestamp_ntz")
    return column if kind == "timestamp_ntz" else column.cast("timestamp_ntz")


def round_to_second(ts: Column) -> Column:
    """Nearest whole second. Halves move away from 2000-01-01, the zero of the
    timestamp format whose rounding this follows."""
    before_zero = ts < F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    shifted = F.when(before_zero, ts + F.expr("INTERVAL '0.499999' SECOND")).otherwise(
        ts + F.expr("INTERVAL '0.5' SECOND")
    )
    return F.date_trunc("second", shifted).cast("timestamp_ntz")
