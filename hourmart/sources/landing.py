"""Hourly zipped JSON-lines objects to staging tables.

Layout: ``year=YYYY/month=MM/day=DD/hour=HH/<feed>.jsonl.zip``.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from datetime import timedelta
from functools import partial, reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hourmart.functions.timebuckets import Moment, as_hour, in_range, moment_literal
from hourmart.schemas import FEEDS, LOAD_HOUR, STAGING, feed_schema
from hourmart.sources.tables import overwrite_partitions
from hourmart.sources.zipmembers import (
    BLOCK_SCHEMA,
    block_rows,
    can_open,
    members,
    read_members,
)

OBJECT_SCHEMA = (
    "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY, "
    "year INT, month INT, day INT, hour INT"
)
_SUFFIX = ".jsonl"
_CORRUPT = "_corrupt_line"
# Compressed size from which an object is read member by member, and its lines are handed on to
# other tasks.
LARGE_OBJECT = 128 << 20


def object_pattern(feed: str) -> str:
    return f"{feed}{_SUFFIX}.zip"


def object_key(feed: str, hour: Moment) -> str:
    """Key of one hour's object below the root."""
    return f"{as_hour(hour):year=%Y/month=%m/day=%d/hour=%H}/{object_pattern(feed)}"


def _listed_folders(root: str, start: Moment | None, end: Moment | None) -> str:
    """Folders to list: the touched days or months of a closed range, so
    that listing does not walk the whole bucket."""
    if start is None or end is None:
        return root
    first, last = as_hour(start).date(), (as_hour(end) - timedelta(hours=1)).date()
    days = (last - first).days + 1
    if days < 1:
        raise ValueError(f"empty range: {start} to {end}")
    form = "year=%Y/month=%m/day=%d" if days <= 92 else "year=%Y/month=%m"
    names = sorted({f"{first + timedelta(days=n):{form}}" for n in range(days)})
    return f"{root}/{{{','.join(names)}}}"


def _load_hour():
    return F.make_timestamp_ntz("year", "month", "day", "hour", F.lit(0), F.lit(0))


def _exists(spark: SparkSession, root: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def scan_objects(
    spark: SparkSession,
    root: str,
    feed: str,
    start: Moment | None = None,
    end: Moment | None = None,
) -> DataFrame:
    """A feed's objects with their load hour. A range without any folder is empty if
    the root is there; a missing root, like every other error, is raised."""
    reader = (
        spark.read.format("binaryFile")
        .schema(OBJECT_SCHEMA)
        .option("basePath", root)
        .option("pathGlobFilter", object_pattern(feed))
    )
    try:
        objects = reader.load(_listed_folders(root, start, end))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND" or not _exists(spark, root):
            raise
        objects = spark.createDataFrame([], OBJECT_SCHEMA)
    return with_load_hour(objects, start, end)


def with_load_hour(
    objects: DataFrame, start: Moment | None = None, end: Moment | None = None
) -> DataFrame:
    """Adds the load hour; the range is a predicate on folder names alone."""
    return in_range(objects, _load_hour(), start, end).select(
        _load_hour().alias(LOAD_HOUR), "path", "length", "content", *_version(objects)
    )


def _version(objects: DataFrame) -> list[str]:
    return [name for name in objects.columns if name == "modificationTime"]


def _unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of whole lines of every member; lines are cut apart by Spark."""
    for batch in batches:
        for hour, content in zip(batch.column(LOAD_HOUR), batch.column("content")):
            with zipfile.ZipFile(io.BytesIO(content.as_py())) as archive:
                for name in members(archive):
                    yield from block_rows(archive, name, hour.as_py())


def _lines(blocks: DataFrame) -> DataFrame:
    line = F.btrim(F.col("line"), F.lit(" \t\r\x0b\f"))
    return (
        blocks.select(LOAD_HOUR, "member", F.explode(F.split("block", "\n")).alias("line"))
        .select(LOAD_HOUR, "member", line.alias("line"))
        .filter("line != ''")
    )


def unzip_lines(objects: DataFrame) -> DataFrame:
    """One row per non-blank line of every member, unzipped on the executors.

    A member is read as a stream and sent on in blocks of whole lines, so a task
    holds the compressed object and one block (or line, if that is longer).
    """
    return _lines(objects.select(LOAD_HOUR, "content").mapInArrow(_unzip, BLOCK_SCHEMA))


def object_lines(objects: DataFrame) -> DataFrame:
    """The same for listed objects of any size: large ones are opened where they lie and
    read member by member, each member in a task of its own."""
    large = objects.filter(F.col("length") >= LARGE_OBJECT).select(LOAD_HOUR, "path")
    # The listing tells, no content is read; large objects are few.
    apart = [(row[0], row[1]) for row in large.collect()]
    # Elsewhere an object must fit in one value.
    if not apart or not all(can_open(path) for _, path in apart):
        return unzip_lines(objects)
    # A test of the length reaches the scan, which then never opens them.
    rest = objects.filter(F.col("length") < LARGE_OBJECT)
    members_of_large = _lines(read_members(objects.sparkSession, apart))
    return unzip_lines(rest).unionByName(members_of_large)


def route_members(lines: DataFrame) -> DataFrame:
    """Adds ``table``: the member's name without its suffix."""
    keep = F.length("member") - len(_SUFFIX)
    return lines.withColumn("table", F.substring(F.col("member"), F.lit(1), keep))


def parse_feed(lines: DataFrame, feed: str) -> DataFrame:
    """A feed's lines as typed columns. An absent field is NULL, an extra field is
    dropped, a line that is no JSON object of these types stops the job."""
    parsed = F.from_json("line", feed_schema(feed), {"mode": "FAILFAST"})
    return lines.select(parsed.alias("row"), LOAD_HOUR).select("row.*", LOAD_HOUR)


def broken_lines(lines: DataFrame, feed: str) -> DataFrame:
    """The lines ``parse_feed`` would stop at, for finding what is wrong."""
    schema = feed_schema(feed).add(_CORRUPT, "string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = lines.withColumn("_row", F.from_json("line", schema, options))
    return parsed.filter(F.col(f"_row.{_CORRUPT}").isNotNull()).drop("_row")


def read_lines(
    spark: SparkSession,
    root: str,
    feed: str,
    start: Moment | None = None,
    end: Moment | None = None,
) -> DataFrame:
    """A feed's lines with the table each belongs to."""
    return route_members(object_lines(scan_objects(spark, root, feed, start, end)))


def store_objects(
    spark: SparkSession, objects: DataFrame, feed: str, root: str, database: str = "default"
) -> None:
    """Replace the staging hours found in a feed's objects.

    Usually each task unzips, parses and writes its own objects and nothing is
    shuffled. If some object is large (the listing tells, no content is read),
    the tasks of its members only unzip and the lines are spread over all tasks.
    The feed's own rows are written in one pass, which also notes the hours whose
    members name other tables. Normally there are none. If there are, just these
    hours of such a table are rewritten from the objects of all feeds, as its own
    object may hold rows of the same hour.
    """
    lines = route_members(object_lines(objects))
    uneven = (objects.agg(F.max("length")).first()[0] or 0) >= LARGE_OBJECT
    if uneven:
        lines = lines.hint("rebalance")
    known = F.col("table").isin(*FEEDS)
    unknown = F.raise_error(F.concat(F.lit("no feed for member "), "member"))
    checked = lines.withColumn("table", F.when(known, F.col("table")).otherwise(unknown))
    seen = Observation()
    stray = F.when(F.col("table") != feed, F.struct("table", LOAD_HOUR))
    noted = checked.observe(seen, F.collect_set(stray).alias("strays"))
    own = parse_feed(noted.filter(F.col("table") == feed), feed)
    # The listing tells the hours, no content is read.
    loaded = sorted(row[0] for row in objects.select(LOAD_HOUR).distinct().collect())
    overwrite_partitions(spark, own, STAGING[feed], database, spread=uneven, hours=loaded)
    hours: dict[str, list] = {}
    for other, hour in seen.get["strays"]:
        hours.setdefault(other, []).append(hour)
    for other, stray_hours in sorted(hours.items()):
        wanted = F.col(LOAD_HOUR).isin([moment_literal(hour) for hour in stray_hours])
        first, end = min(stray_hours), max(stray_hours) + timedelta(hours=1)
        everywhere = [
            route_members(object_lines(scan_objects(spark, root, source, first, end).filter(wanted)))
            for source in FEEDS
        ]
        routed = reduce(DataFrame.unionByName, everywhere).filter(F.col("table") == other)
        rows = parse_feed(routed, other)
        overwrite_partitions(spark, rows, STAGING[other], database, hours=sorted(set(stray_hours)))


LEDGER = "landed_objects"


def _ledger(spark: SparkSession, database: str) -> str:
    name = f"{database}.{LEDGER}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (path STRING, modified TIMESTAMP, length BIGINT, "
        "feed STRING) USING parquet PARTITIONED BY (feed)"
    )
    return name


def load_changed(
    spark: SparkSession,
    root: str,
    feed: str,
    start: Moment | None = None,
    end: Moment | None = None,
    database: str = "default",
) -> int:
    """Land a feed's objects that are new or not as they were when they last landed; returns
    their number. A ledger keeps path, time and length of each version that has landed; it is
    written last, so what fails is landed again."""
    ledger = _ledger(spark, database)
    listed = scan_objects(spark, root, feed, start, end)
    seen = spark.table(ledger).filter(F.col("feed") == feed).drop("feed")
    version = listed.select(
        "path", F.col("modificationTime").alias("modified"), "length", LOAD_HOUR
    )
    new = version.join(seen, ["path", "modified", "length"], "left_anti").collect()
    if not new:
        return 0
    hours = sorted({row[LOAD_HOUR] for row in new})
    found = scan_objects(spark, root, feed, hours[0], hours[-1] + timedelta(hours=1))
    wanted = found.filter(F.col(LOAD_HOUR).isin([moment_literal(hour) for hour in hours]))
    store_objects(spark, wanted, feed, root, database)
    landed = spark.createDataFrame(
        [(row["path"], row["modified"], row["length"], feed) for row in new],
        "path STRING, modified TIMESTAMP, length BIGINT, feed STRING",
    )
    landed.coalesce(1).write.insertInto(ledger, overwrite=False)
    return len(new)


def load_feed(
    spark: SparkSession,
    root: str,
    feed: str,
    start: Moment | None = None,
    end: Moment | None = None,
    database: str = "default",
) -> None:
    """Land a feed's objects of a range. Hours without an object keep their rows."""
    store_objects(spark, scan_objects(spark, root, feed, start, end), feed, root, database)


load_browser = partial(load_feed, feed="browser_events")
load_device = partial(load_feed, feed="device_events")
load_geo = partial(load_feed, feed="geo_events")
load_location = partial(load_feed, feed="location_events")
