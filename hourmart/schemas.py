"""Columns, lengths, keys and layout of every feed and table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Feed fields, table columns, column lengths and keys.
FEED_FIELDS: dict[str, str] = {
    "browser_events": (
        "event_id STRING, click_id STRING, event_timestamp STRING, event_type STRING, "
        "browser_name STRING, browser_language STRING, browser_user_agent STRING"
    ),
    "device_events": (
        "click_id STRING, device_type STRING, device_is_mobile BOOLEAN, user_custom_id STRING, "
        "user_domain_id STRING, os STRING, os_name STRING, os_timezone STRING"
    ),
    "geo_events": (
        "click_id STRING, geo_country STRING, geo_timezone STRING, geo_region_name STRING, "
        "ip_address STRING, geo_latitude DOUBLE, geo_longitude DOUBLE"
    ),
    "location_events": (
        "event_id STRING, page_url STRING, page_url_path STRING, referer_url STRING, "
        "referer_medium STRING, utm_medium STRING, utm_source STRING, utm_content STRING, "
        "utm_campaign STRING"
    ),
}

FEEDS: tuple[str, ...] = tuple(FEED_FIELDS)
LOAD_HOUR = "data_partition_ts"


def feed_schema(feed: str) -> T.StructType:
    """Fields of one JSON line of a feed, without the load hour."""
    return T.StructType.fromDDL(FEED_FIELDS[feed])


@dataclass(frozen=True)
class TableSpec:
    """One stored table.

    ``hour`` names the column whose hour places a row in a partition by day and
    hour, so that writers of different hours never share one.
    ``hidden`` columns are computed on write and are not part of the read view.
    ``clustered`` is the key other tables look rows up by: with ``spark.hourmart.buckets``
    set, the table is created in that many sorted buckets of it.
    """

    name: str
    columns: str
    hour: str
    lengths: tuple[tuple[str, int], ...] = ()
    required: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    partitions: tuple[str, ...] = ("dt", "hr")
    hidden: tuple[tuple[str, str, str], ...] = ()
    clustered: str = ""

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)

    @property
    def names(self) -> list[str]:
        return self.schema.names


# Text timestamps carry no usable row-group statistics, so staging browser rows
# keep a typed copy of the event time that only serves to skip row groups.
EVENT_TIME_INDEX = "event_ts_index"

LOOKUP_KEYS: dict[str, str] = {
    "browser_events": "event_id", "device_events": "click_id", "location_events": "event_id",
}

STAGING: dict[str, TableSpec] = {
    feed: TableSpec(
        name=feed,
        columns=f"{fields}, {LOAD_HOUR} TIMESTAMP_NTZ",
        hour=LOAD_HOUR,
        hidden=(
            ((EVENT_TIME_INDEX, "TIMESTAMP_NTZ", "try_cast(event_timestamp AS TIMESTAMP_NTZ)"),)
            if feed == "browser_events"
            else ()
        ),
        clustered=LOOKUP_KEYS.get(feed, ""),
    )
    for feed, fields in FEED_FIELDS.items()
}

# Raw layer.
RAW_BROWSER = TableSpec(
    name="raw_browser_events",
    clustered=LOOKUP_KEYS["browser_events"],
    columns=(
        "click_id STRING, event_id STRING, event_timestamp TIMESTAMP_NTZ, event_type STRING, "
        "browser_name STRING, browser_language STRING, browser_user_agent STRING"
    ),
    hour="event_timestamp",
    lengths=(
        ("click_id", 40), ("event_id", 40), ("event_type", 10),
        ("browser_name", 20), ("browser_language", 10),
    ),
)
RAW_DEVICE = TableSpec(
    name="raw_device_events",
    clustered=LOOKUP_KEYS["device_events"],
    columns=f"{FEED_FIELDS['device_events']}, {LOAD_HOUR} TIMESTAMP_NTZ",
    hour=LOAD_HOUR,
    lengths=(
        ("click_id", 40), ("device_type", 20), ("user_custom_id", 50), ("user_domain_id", 40),
        ("os_name", 20), ("os_timezone", 30),
    ),
)
RAW_GEO = TableSpec(
    name="raw_geo_events",
    columns=f"{FEED_FIELDS['geo_events']}, {LOAD_HOUR} TIMESTAMP_NTZ",
    hour=LOAD_HOUR,
    lengths=(
        ("click_id", 40), ("geo_country", 10), ("geo_timezone", 30), ("geo_region_name", 40),
        ("ip_address", 30),
    ),
)
RAW_LOCATION = TableSpec(
    name="raw_location_events",
    clustered=LOOKUP_KEYS["location_events"],
    columns=f"{FEED_FIELDS['location_events']}, {LOAD_HOUR} TIMESTAMP_NTZ",
    hour=LOAD_HOUR,
    lengths=(
        ("event_id", 40), ("referer_medium", 32), ("utm_medium", 32), ("utm_source", 32),
        ("utm_content", 32), ("utm_campaign", 32),
    ),
)

# Core layer. ``event_hour`` is ours: the hour before rounding.
CORE_BUY_PRODUCT = TableSpec(
    name="core_buy_product_table",
    columns=(
        "click_id STRING, user_custom_id STRING, page_url_path STRING, "
        "event_timestamp TIMESTAMP_NTZ, event_hour TIMESTAMP_NTZ"
    ),
    hour="event_hour",
    lengths=(("click_id", 40), ("user_custom_id", 50)),
    required=("click_id", "user_custom_id", "page_url_path", "event_timestamp"),
)
CORE_PAYMENT = TableSpec(
    name="core_payment_confirm",
    columns="event_timestamp TIMESTAMP_NTZ, count_payment INT, count_confirmation INT",
    hour="event_timestamp",
    required=("event_timestamp",),
    key=("event_timestamp",),
)

# Marts.
DM_BUY_PRODUCT = TableSpec(
    name="dm_buy_product",
    columns="event_timestamp TIMESTAMP_NTZ, count_buy_product INT",
    hour="event_timestamp",
    required=("event_timestamp", "count_buy_product"),
    key=("event_timestamp",),
)
DM_TOP10_PAGE = TableSpec(
    name="dm_top10_page",
    columns="event_timestamp TIMESTAMP_NTZ, page_url_path STRING, count_page_url_path INT",
    hour="event_timestamp",
    required=("event_timestamp", "page_url_path", "count_page_url_path"),
    key=("event_timestamp", "page_url_path"),
)
DM_HOURLY_EVENTS = TableSpec(
    name="dm_hourly_events",
    columns="event_hour TIMESTAMP_NTZ, event_count INT",
    hour="event_hour",
    required=("event_hour", "event_count"),
    key=("event_hour",),
)
DM_DIST_EVENTS = TableSpec(
    name="dm_dist_events",
    columns=(
        "event_timestamp TIMESTAMP_NTZ, count_cart INT, count_payment INT, count_confirmation INT"
    ),
    hour="event_timestamp",
    required=("event_timestamp",),
    key=("event_timestamp",),
)

RAW: tuple[TableSpec, ...] = (RAW_BROWSER, RAW_DEVICE, RAW_GEO, RAW_LOCATION)
CORE: tuple[TableSpec, ...] = (CORE_BUY_PRODUCT, CORE_PAYMENT)
MARTS: tuple[TableSpec, ...] = (DM_BUY_PRODUCT, DM_TOP10_PAGE, DM_HOURLY_EVENTS, DM_DIST_EVENTS)
