"""Raw layer: staging rows without exact copies, typed.

``start`` and ``end`` bound the half-open hour range; ``None`` means unbounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart.functions import in_range, parse_timestamp, plain_timestamp, within
from hourmart.functions.timebuckets import Moment
from hourmart.operators.dedupe import distinct_rows
from hourmart.schemas import (
    EVENT_TIME_INDEX,
    LOAD_HOUR,
    RAW_BROWSER,
    RAW_DEVICE,
    RAW_GEO,
    RAW_LOCATION,
    TableSpec,
)


def _near_event_time(
    staging: DataFrame, start: Moment | None, end: Moment | None
) -> DataFrame:
    """Let the scan skip row groups by the typed event time, where it is stored."""
    if EVENT_TIME_INDEX not in staging.columns:
        return staging
    index = F.col(EVENT_TIME_INDEX)
    near = within(index, start, end)
    return staging if near is None else staging.filter(near | index.isNull())


def browser_in_range(
    staging: DataFrame, start: Moment | None = None, end: Moment | None = None
) -> DataFrame:
    """Staging browser rows by event time; an event may be loaded in any hour."""
    return in_range(
        _near_event_time(staging, start, end), parse_timestamp("event_timestamp"), start, end
    )


def raw_browser_events(
    staging: DataFrame, start: Moment | None = None, end: Moment | None = None
) -> DataFrame:
    """Hour by event time. Copies are told by the text of the timestamp, so two
    spellings of one instant both stay; the cast comes after."""
    unique = distinct_rows(browser_in_range(staging, start, end), RAW_BROWSER.names)
    return unique.withColumn("event_timestamp", parse_timestamp("event_timestamp"))


def _by_load_hour(
    staging: DataFrame, spec: TableSpec, start: Moment | None, end: Moment | None
) -> DataFrame:
    load_hour = plain_timestamp(staging, LOAD_HOUR)
    rows = in_range(staging, load_hour, start, end).withColumn(LOAD_HOUR, load_hour)
    return distinct_rows(rows, spec.names)


def raw_device_events(
    staging: DataFrame, start: Moment | None = None, end: Moment | None = None
) -> DataFrame:
    return _by_load_hour(staging, RAW_DEVICE, start, end)


def raw_geo_events(
    staging: DataFrame, start: Moment | None = None, end: Moment | None = None
) -> DataFrame:
    return _by_load_hour(staging, RAW_GEO, start, end)


def raw_location_events(
    staging: DataFrame, start: Moment | None = None, end: Moment | None = None
) -> DataFrame:
    return _by_load_hour(staging, RAW_LOCATION, start, end)
