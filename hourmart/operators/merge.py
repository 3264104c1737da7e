"""Write semantics as pure functions: replace a range, upsert by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart.functions.timebuckets import Moment, within


def inside(rows: DataFrame, hour: str, start: Moment, end: Moment, name: str) -> DataFrame:
    """The rows; one outside the range would replace hours that are not its own, and raises."""
    own = F.coalesce(within(F.col(hour), start, end), F.lit(False))
    message = F.lit(f"{name}: row outside the hours being written")
    return rows.withColumn(hour, F.when(own, F.col(hour)).otherwise(F.raise_error(message)))


def replace_range(
    target: DataFrame, rows: DataFrame, hour: str, start: Moment, end: Moment, name: str = "rows"
) -> DataFrame:
    """Target with ``[start, end)`` taken out and the new rows put in, guarded as in a write."""
    kept = target.filter(F.coalesce(~within(F.col(hour), start, end), F.lit(True)))
    return kept.unionByName(inside(rows, hour, start, end, name).select(*target.columns))


def upsert(target: DataFrame, updates: DataFrame, key: list[str]) -> DataFrame:
    """Updates win on equal keys; keys without an update stay as they are.

    Keys hold no NULL (they are primary keys), so plain equality is enough.
    """
    kept = target.join(updates.select(*key), key, "left_anti").select(*target.columns)
    return updates.select(*target.columns).unionByName(kept)
