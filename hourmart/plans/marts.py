"""Hourly marts. All group by the core row's own hour, not by the rounded time,
which may fall into the next hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart.functions import bucket, in_range, parse_timestamp
from hourmart.functions.timebuckets import HOUR, Moment
from hourmart.operators.topk import top_per_group
from hourmart.plans.raw import browser_in_range

TOP_PAGES = 10


def _bought(core: DataFrame, start: Moment | None, end: Moment | None) -> DataFrame:
    return in_range(core, "event_hour", start, end).select(
        F.col("event_hour").alias("event_timestamp"), "page_url_path"
    )


def dm_buy_product(
    core: DataFrame, start: Moment | None = None, end: Moment | None = None
) -> DataFrame:
    """Bought products per hour."""
    return (
        _bought(core, start, end)
        .groupBy("event_timestamp")
        .agg(F.count("page_url_path").alias("count_buy_product"))
    )


def dm_top10_page(
    core: DataFrame,
    start: Moment | None = None,
    end: Moment | None = None,
    k: int = TOP_PAGES,
) -> DataFrame:
    """The ten pages of an hour with most purchases; equal counts by page name."""
    counted = (
        _bought(core, start, end)
        .groupBy("event_timestamp", "page_url_path")
        .agg(F.count("page_url_path").alias("count_page_url_path"))
    )
    order = [F.col("count_page_url_path").desc(), F.col("page_url_path").asc()]
    return top_per_group(counted, ["event_timestamp"], order, k)


def dm_hourly_events(
    staging_browser: DataFrame,
    start: Moment | None = None,
    end: Moment | None = None,
    grain: str = HOUR,
) -> DataFrame:
    """Staged browser events per event hour, copies included."""
    rows = browser_in_range(staging_browser, start, end)
    hour = bucket(parse_timestamp("event_timestamp"), grain)
    return rows.groupBy(hour.alias("event_hour")).agg(F.count(F.lit(1)).alias("event_count"))


def dm_dist_events(
    core: DataFrame,
    payments: DataFrame,
    start: Moment | None = None,
    end: Moment | None = None,
) -> DataFrame:
    """Purchases, payments and confirmations per hour with a purchase. Both sides
    hold one row an hour, so Spark joins them by broadcast or a small shuffle."""
    cart = (
        _bought(core, start, end)
        .groupBy("event_timestamp")
        .agg(F.count("page_url_path").alias("count_cart"))
    )
    paid = in_range(payments, "event_timestamp", start, end).select(
        "event_timestamp", "count_payment", "count_confirmation"
    )
    return cart.join(paid, "event_timestamp", "left").select(
        "event_timestamp", "count_cart", "count_payment", "count_confirmation"
    )
