"""Exact duplicate removal.

``distinct`` plans as a hash aggregate with a map-side pass, so a group of
copies shrinks to one row per task before the shuffle, and the shuffle hashes
every column: no key can gather the rows of others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def distinct_rows(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row per combination of the columns; NULLs count as equal."""
    return rows.select(*columns).distinct()


def distinct_pairs(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Distinct (key, value) with a usable key: the lookup side of a join."""
    return rows.filter(rows[key].isNotNull()).select(key, value).distinct()
