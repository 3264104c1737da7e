"""Feed completeness: which hours have rows of every feed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmart.functions import bucket, in_range, plain_timestamp
from hourmart.functions.timebuckets import HOUR, Moment, moment_literal
from hourmart.schemas import FEEDS, LOAD_HOUR, STAGING
from hourmart.sources.partitions import hours_between
from hourmart.sources.tables import ensure_table


def hours_ready(
    staging: dict[str, DataFrame],
    start: Moment | None = None,
    end: Moment | None = None,
    grain: str = HOUR,
) -> DataFrame:
    """One row per hour of the range with the row count of each feed.

    Hours without any row are listed too. Open bounds run from the first to the
    last hour that holds data.
    """
    tagged = []
    for feed in FEEDS:
        rows = staging[feed]
        hour = plain_timestamp(rows, LOAD_HOUR)
        tagged.append(
            in_range(rows, hour, start, end).select(
                bucket(hour, grain).alias("load_hour"), F.lit(feed).alias("feed")
            )
        )
    counts = (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("load_hour")
        .agg(*[F.count_if(F.col("feed") == feed).alias(feed) for feed in FEEDS])
    )
    step = F.expr(f"INTERVAL '1' {grain.upper()}")
    spark = counts.sparkSession
    if start is not None and end is not None:
        bounds = spark.range(1).select(
            moment_literal(start).alias("first"), (moment_literal(end) - step).alias("last")
        )
    else:
        bounds = counts.agg(F.min("load_hour").alias("first"), F.max("load_hour").alias("last"))
    spine = bounds.filter("first <= last").select(
        F.explode(F.sequence("first", "last", step)).alias("load_hour")
    )
    ready = reduce(lambda a, b: a & b, [F.col(feed) > 0 for feed in FEEDS])
    return (
        spine.join(counts, "load_hour", "left")
        .select("load_hour", *[F.coalesce(feed, F.lit(0)).alias(feed) for feed in FEEDS])
        .withColumn("ready", ready)
    )


def stored_hours_ready(
    spark: SparkSession, start: Moment, end: Moment, database: str = "default"
) -> DataFrame:
    """The same for the stored staging tables: the hour of a row is that of its partition, so
    no column is read and the rows are counted from file footers."""
    staging = {}
    for feed in FEEDS:
        stored = spark.table(ensure_table(spark, STAGING[feed], database))
        hour = F.make_timestamp_ntz(
            F.year("dt"), F.month("dt"), F.day("dt"), F.col("hr"), F.lit(0), F.lit(0)
        )
        staging[feed] = stored.filter(hours_between(start, end)).select(hour.alias(LOAD_HOUR))
    return hours_ready(staging, start, end)
