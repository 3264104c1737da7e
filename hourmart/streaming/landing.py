"""Incremental landing: new objects go to staging as they appear."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hourmart.functions.timebuckets import moment_literal
from hourmart.schemas import LOAD_HOUR
from hourmart.sources.landing import (
    OBJECT_SCHEMA,
    object_pattern,
    scan_objects,
    store_objects,
    with_load_hour,
)


def land_incremental(
    spark: SparkSession,
    root: str,
    feed: str,
    checkpoint: str,
    database: str = "default",
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Land every object not seen before, then stop.

    The stream only finds the new objects' hours, at most ``files_per_batch`` of
    them in a batch, and its checkpoint remembers the objects; their content is
    read by the batch that stores the hours. A batch may be replayed after a
    failure: it replaces the same hours again, so nothing doubles. An object
    replaced in place is not picked up anew: reload its hour with ``load_feed``.
    """

    def store(batch: DataFrame, _batch_id: int) -> None:
        hours = sorted(row[0] for row in batch.distinct().collect())
        if not hours:
            return
        session = batch.sparkSession
        end = hours[-1] + timedelta(hours=1)
        found = scan_objects(session, root, feed, hours[0], end)
        new = found.filter(F.col(LOAD_HOUR).isin([moment_literal(hour) for hour in hours]))
        store_objects(session, new, feed, root, database)

    objects = (
        spark.readStream.format("binaryFile")
        .schema(OBJECT_SCHEMA)
        .option("basePath", root)
        .option("pathGlobFilter", object_pattern(feed))
        .option("maxFilesPerTrigger", files_per_batch)
        .load(root)
    )
    return (
        with_load_hour(objects)
        .select(LOAD_HOUR)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .queryName(f"land_{feed}")
        .trigger(availableNow=True)
        .start()
    )
