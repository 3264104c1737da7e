"""The shape of the physical plans: what is pushed down and what is shuffled."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pytest
from conftest import TESTDATA, at

from hourmart import fixtures, schemas
from hourmart.operators import prefilter
from hourmart.operators.prefilter import keep_matching
from hourmart.plans import core, marts, raw
from hourmart.sources.tables import overwrite_partitions, read_table

START, END = "2024-01-01 10:00:00", "2024-01-01 12:00:00"


@contextmanager
def conf(spark, values):
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in values:
            spark.conf.unset(key)


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def exchanges(text: str) -> list[str]:
    return re.findall(r"Exchange (\w+\(.*)", text)


@pytest.fixture(scope="module")
def stored(spark):
    spark.sql("CREATE DATABASE plans")
    for feed, rows in fixtures.staging_frames(spark, str(TESTDATA / "sf0.001")).items():
        part = rows.filter("data_partition_ts < TIMESTAMP_NTZ'2024-01-01 12:00:00'")
        overwrite_partitions(spark, part, schemas.STAGING[feed], "plans")
    for spec in schemas.RAW:
        build = getattr(raw, spec.name)
        staged = read_table(spark, schemas.STAGING[spec.name.removeprefix("raw_")], "plans")
        overwrite_partitions(spark, build(staged), spec, "plans")
    yield lambda spec, *bounds: read_table(spark, spec, "plans", *bounds)
    spark.sql("DROP DATABASE plans CASCADE")


def test_range_prunes_partitions_and_reaches_the_scan(stored):
    text = plan(raw.raw_device_events(stored(schemas.STAGING["device_events"], START, END)))
    assert re.search(r"PartitionFilters: \[.*dt#.*hr#", text)
    assert "GreaterThanOrEqual(data_partition_ts," in text
    assert "LessThan(data_partition_ts," in text


def test_event_time_index_reaches_the_scan(stored):
    staging = stored(schemas.STAGING["browser_events"])
    text = plan(raw.raw_browser_events(staging, START, END))
    assert f"GreaterThanOrEqual({schemas.EVENT_TIME_INDEX}," in text
    hourly = plan(marts.dm_hourly_events(staging, START, END))
    columns = re.search(r"ReadSchema: struct<([^>]*)>", hourly).group(1)
    assert [c.split(":")[0] for c in columns.split(",")] == [
        "event_timestamp", schemas.EVENT_TIME_INDEX,
    ]


def test_raw_dedupe_is_one_shuffle_with_a_map_side_pass(stored):
    text = plan(raw.raw_geo_events(stored(schemas.STAGING["geo_events"])))
    assert len(exchanges(text)) == 1
    assert text.count("HashAggregate") == 2


def test_chain_windows_share_one_shuffle(spark, stored):
    with conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(
            core.core_buy_product(
                stored(schemas.RAW_BROWSER),
                stored(schemas.RAW_LOCATION),
                stored(schemas.RAW_DEVICE),
            )
        )
    assert len(re.findall(r"\bWindow \[", text)) == 2
    # Browser by event, location distinct and by event, both windows and the removal
    # of copies by hour and click, bought views by click, device distinct and by click.
    kinds = [kind.split("(")[1].split(")")[0] for kind in exchanges(text)]
    keys = sorted(re.sub(r"#\d+|, \d+.*", "", kind) for kind in kinds)
    assert len(keys) == 7
    assert len([1 for kind in exchanges(text) if "event_hour" in kind]) == 1
    # Users join the bought views only: above the windows, not below.
    assert text.index("LeftOuter") < text.index("Window [")
    location = re.search(r"ReadSchema: struct<event_id:string,page_url_path:string>", text)
    assert location


def test_top_pages_are_limited_before_the_shuffle(spark):
    rows = spark.createDataFrame(
        [(at("10:00"), "/a")], "event_hour TIMESTAMP_NTZ, page_url_path STRING"
    )
    text = plan(marts.dm_top10_page(rows))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_history_is_cut_by_broadcast_only_within_the_limit(spark):
    history = spark.range(1000).selectExpr("cast(id AS string) event_id", "'/p' page_url_path")
    wanted = history.select("event_id").limit(3)
    small = keep_matching(history, wanted, "event_id", wanted_rows=3)
    assert "BroadcastHashJoin" in plan(small) and small.count() == 3
    assert keep_matching(history, wanted, "event_id", wanted_rows=4, limit=3) is history


def test_narrow_run_equals_the_wide_one(stored):
    inputs = [stored(s) for s in (schemas.RAW_BROWSER, schemas.RAW_LOCATION, schemas.RAW_DEVICE)]
    whole = core.core_buy_product(*inputs)
    bounded = core.core_buy_product(*inputs, start="2024-01-01 00:00:00", end=END)
    assert sorted(map(str, bounded.collect())) == sorted(map(str, whole.collect()))
    assert "LeftSemi" in plan(bounded)


def test_medium_run_cuts_a_large_history_by_bloom_filter(spark, stored, monkeypatch):
    """With the history-size threshold lowered to that of the fixture."""
    monkeypatch.setattr(prefilter, "BROADCAST_ROWS", -1)
    large = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    with conf(spark, {large: "0", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        rows = core.core_payment_confirm(
            stored(schemas.RAW_BROWSER, START, END),
            stored(schemas.STAGING["device_events"]),
            stored(schemas.STAGING["location_events"]),
            START,
            END,
        )
        text = plan(rows)
    # Both histories are filtered below the removal of copies.
    assert len(re.findall(r"Filter .*might_contain", text)) == 2
    assert "LeftSemi" not in text


def test_skewed_joins_are_split(spark):
    """A third of the events carry one click, another third one event id."""
    third = 60_000
    filler = "md5(cast(id AS string))"
    browser = spark.range(3 * third).selectExpr(
        f"if(id % 3 = 0, 'hot', {filler}) AS event_id",
        f"if(id % 3 = 1, 'hot', {filler}) AS click_id",
        "TIMESTAMP_NTZ'2024-01-01 10:00:00' + make_dt_interval(0, 0, 0, id % 3600)"
        " AS event_timestamp",
        "'v' AS event_type",
    )
    pages = "array('/product_1', '/cart', '/payment', '/confirmation')"
    location = browser.selectExpr(
        "event_id", f"element_at({pages}, cast(hash(event_id) & 3 AS int) + 1) AS page_url_path"
    )
    device = browser.selectExpr("click_id", "concat('u', click_id) AS user_custom_id")
    tight = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
        "spark.sql.shuffle.partitions": "16",
    }
    with conf(spark, tight):
        for frame in (
            core.core_payment_confirm(browser, device, location),
            core.core_buy_product(browser, location, device),
        ):
            frame.collect()
            final = frame._jdf.queryExecution().executedPlan().toString()
            final = final.split("Initial Plan")[0]
            assert "SortMergeJoin(skew=true)" in final
