"""Partition predicates: days and hours of a range, and sets of hours as runs."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourmart.functions.timebuckets import Moment, as_hour

HOUR = timedelta(hours=1)
# A predicate names at most so many runs of hours; beyond, the closest runs become one.
RUNS = 200


def _days(start: Moment | None, end: Moment | None) -> Column:
    """Partition predicate for every day a range touches."""
    condition = F.lit(True)
    if start is not None:
        condition &= F.col("dt") >= F.lit(as_hour(start).date())
    if end is not None:
        condition &= F.col("dt") <= F.lit((as_hour(end) - timedelta(hours=1)).date())
    return condition


def hours_between(start: Moment | None, end: Moment | None) -> Column:
    """Partition predicate for a range of hours."""
    dt, hr = F.col("dt"), F.col("hr")
    condition = _days(start, end)
    if start is not None:
        first = as_hour(start)
        condition &= (dt > F.lit(first.date())) | (hr >= first.hour)
    if end is not None:
        last = as_hour(end) - timedelta(hours=1)
        condition &= (dt < F.lit(last.date())) | (hr <= last.hour)
    return condition


def runs_of(hours: Iterable[datetime], gap: int = 0) -> list[tuple[datetime, datetime]]:
    """Hours as half-open runs; up to ``gap`` hours between two of them are taken along."""
    runs: list[list[datetime]] = []
    for hour in sorted(set(hours)):
        if runs and hour - runs[-1][1] <= gap * HOUR:
            runs[-1][1] = hour + HOUR
        else:
            runs.append([hour, hour + HOUR])
    return [(first, end) for first, end in runs]


def in_runs(hours: Iterable[datetime]) -> Column:
    """Partition predicate for a set of hours, or a few more if they are widely strewn."""
    runs = runs_of(hours)
    if len(runs) > RUNS:
        spaces = sorted((b[0] - a[1] for a, b in zip(runs, runs[1:])), reverse=True)
        widest = spaces[RUNS - 1]
        runs = runs_of((h for run in runs for h in _hours_of(run)), widest // HOUR)
    if not runs:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [hours_between(first, end) for first, end in runs])


def _hours_of(run: tuple[datetime, datetime]) -> Iterable[datetime]:
    return (run[0] + n * HOUR for n in range((run[1] - run[0]) // HOUR))
