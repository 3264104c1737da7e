"""Top rows per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(rows: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows of each group. Spark keeps ``k`` rows per group and task
    before the shuffle, so a large group does not gather in one task."""
    window = Window.partitionBy(*group).orderBy(*order)
    ranked = rows.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") <= k).drop("_rank")
