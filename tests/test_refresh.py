"""Notes of staging writes: what runs read, and what a refresh computes again."""

from __future__ import annotations

import re
from datetime import timedelta

import pytest
from conftest import at, rows_of
from pyspark.sql import functions as F
from test_landing import event, put

from hourmart import schemas
from hourmart.plans import backfill as plans
from hourmart.plans.refresh import refresh
from hourmart.sources import hournotes, landing, partitions
from hourmart.sources.tables import overwrite_partitions, read_by_event_time, read_table

BROWSER = schemas.STAGING["browser_events"]
HOUR = timedelta(hours=1)


def land(spark, root, database, hour, browser=(), device=(), location=()):
    feeds = {"browser_events": browser, "device_events": device, "location_events": location}
    end = f"2024-01-01 {hour + 1:02d}:00:00"
    for feed, rows in feeds.items():
        if rows:
            put(root, feed, hour, {f"{feed}.jsonl": rows})
            landing.load_feed(spark, str(root), feed, f"2024-01-01 {hour:02d}:00:00", end, database)


def page(event_id, path):
    return {"event_id": event_id, "page_url_path": path}


def tables_of(spark, database):
    specs = (*schemas.RAW, *schemas.CORE, *schemas.MARTS)
    return {spec.name: rows_of(read_table(spark, spec, database)) for spec in specs}


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def first_landing(spark, root, database):
    land(
        spark, root, database, 10, [event(1), event(2), event(3)],
        [{"click_id": "c", "user_custom_id": "u"}],
        [page("e1", "/product_1"), page("e2", "/payment"), page("e3", "/confirmation")],
    )


def test_a_one_hour_run_reads_the_load_hours_of_its_events(spark, tmp_path, database):
    for hour in (8, 9, 10, 11):
        land(spark, tmp_path, database, hour, [event(hour, hour)])
    land(spark, tmp_path, database, 14, [event(50, 10), event(51, 14)])
    hours = hournotes.load_hours_of_events(spark, database, at("10:00"), at("11:00"))
    assert hours == [at("10:00"), at("14:00")]
    run = plans.Run(spark, at("10:00"), at("11:00"), database, 1000)
    for table in (schemas.RAW_BROWSER, schemas.DM_HOURLY_EVENTS):
        frame = dict((s.name, b) for s, b in plans.STEPS)[table.name](run)
        filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan(frame), re.S).group(1)
        assert "dt#" in filters and "hr#" in filters
    staged = read_by_event_time(spark, BROWSER, database, at("10:00"), at("11:00"))
    files = {f.split("dt=")[1].split("/")[1] for f in staged.inputFiles()}
    assert files == {"hr=10", "hr=14"}
    raw = dict((s.name, b) for s, b in plans.STEPS)[schemas.RAW_BROWSER.name](run)
    assert {r.event_id for r in raw.collect()} == {"e10", "e50"}
    # A load hour written again: its old pair is read in vain, the new one is there.
    land(spark, tmp_path, database, 14, [event(52, 8)])
    hours = hournotes.load_hours_of_events(spark, database, at("08:00"), at("09:00"))
    assert hours == [at("08:00"), at("14:00")]


def test_rows_are_never_missed_while_a_write_is_unfinished(spark, tmp_path, database, monkeypatch):
    land(spark, tmp_path, database, 10, [event(1)])
    late = [event(2, 10), event(3, 12)]

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(hournotes, "note", broken)
        with pytest.raises(OSError):
            land(spark, tmp_path, database, 12, late)
    hours = hournotes.load_hours_of_events(spark, database, at("10:00"), at("11:00"))
    assert hours == [at("10:00"), at("12:00")]
    # Landed again: the old announcement goes with the new one.
    land(spark, tmp_path, database, 12, [event(3, 12)])
    hours = hournotes.load_hours_of_events(spark, database, at("10:00"), at("11:00"))
    assert hours == [at("10:00")]


def test_unreadable_times_keep_their_load_hour_in_every_run(spark, tmp_path, database):
    land(spark, tmp_path, database, 10, [event(1)])
    land(spark, tmp_path, database, 12, [event(3, 12, event_timestamp="no time"), event(4, 12)])
    land(spark, tmp_path, database, 13, [event(5, 13)])
    hours = hournotes.load_hours_of_events(spark, database, at("10:00"), at("11:00"))
    assert hours == [at("10:00"), at("12:00")]


def test_rows_from_before_the_notes_are_noted_first(spark, tmp_path, database):
    land(spark, tmp_path, database, 10, [event(1), event(2, 9)])
    for table in (hournotes.PAIRS, hournotes.CHANGES):
        spark.sql(f"DROP TABLE {database}.{table}")
    assert hournotes.load_hours_of_events(spark, database, at("09:00"), at("10:00")) is None
    land(spark, tmp_path, database, 12, [event(3, 12)])
    hours = hournotes.load_hours_of_events(spark, database, at("09:00"), at("10:00"))
    assert hours == [at("10:00")]


def test_refresh_follows_late_events_and_pages(spark, tmp_path, database):
    assert refresh(spark, database) == []
    first_landing(spark, tmp_path, database)
    assert refresh(spark, database) == [at("10:00")]
    assert refresh(spark, database) == []
    bought = read_table(spark, schemas.CORE_BUY_PRODUCT, database)
    assert [r.page_url_path for r in bought.collect()] == ["/product_1"]
    # An event of hour 10, and the page of one, land later; nobody names a range.
    land(
        spark, tmp_path, database, 13, [event(0, 10)], (),
        [page("e0", "/product_7"), page("e2", "/product_2")],
    )
    assert refresh(spark, database) == [at("10:00")]
    after = tables_of(spark, database)
    assert len(after["raw_browser_events"]) == 4
    assert after["dm_hourly_events"] == [("4", "2024-01-01 10:00:00")]
    plans.backfill(spark, at("09:00"), at("15:00"), database)
    assert tables_of(spark, database) == after


def test_replaced_rows_touch_the_hours_they_leave(spark, tmp_path, database):
    first_landing(spark, tmp_path, database)
    refresh(spark, database)
    land(spark, tmp_path, database, 10, [event(1, 11)], (), [page("e9", "/home")])
    assert refresh(spark, database) == [at("10:00"), at("11:00")]
    after = tables_of(spark, database)
    assert after["dm_hourly_events"] == [("1", "2024-01-01 11:00:00")]
    assert after["core_buy_product_table"] == []


def test_what_lands_during_a_refresh_stays_to_be_done(spark, tmp_path, database):
    first_landing(spark, tmp_path, database)
    batches, _ = hournotes.pending(spark, database)
    land(spark, tmp_path, database, 11, [event(9, 11)])
    hournotes.settle(spark, database, batches)
    assert refresh(spark, database) == [at("11:00")]


def test_runs():
    hours = [at("01:00"), at("02:00"), at("05:00"), at("05:00"), at("09:00")]
    assert partitions.runs_of(hours) == [
        (at("01:00"), at("03:00")), (at("05:00"), at("06:00")), (at("09:00"), at("10:00")),
    ]
    assert partitions.runs_of(hours, 2) == [(at("01:00"), at("06:00")), (at("09:00"), at("10:00"))]
    assert partitions.runs_of([]) == []


def test_many_runs_become_fewer_that_hold_them_all(spark, monkeypatch):
    monkeypatch.setattr(partitions, "RUNS", 3)
    hours = [at("00:00") + n * HOUR for n in (0, 2, 9, 11, 14, 40, 41, 90)]
    stored = spark.range(100).select(
        F.to_date(F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600)).alias("dt"),
        (F.col("id") % 24).cast("int").alias("hr"),
        "id",
    )
    found = {r.id for r in stored.filter(partitions.in_runs(hours)).collect()}
    assert {0, 2, 9, 11, 14, 40, 41, 90} <= found
    assert found <= {*range(15), 40, 41, 90}


def test_direct_staging_writes_are_noted_too(spark, database):
    rows = spark.createDataFrame(
        [("e1", "c", "2024-01-01 05:30:00", "v", None, None, None, at("06:00"))], BROWSER.schema
    )
    overwrite_partitions(spark, rows, BROWSER, database)
    hours = hournotes.load_hours_of_events(spark, database, at("05:00"), at("06:00"))
    assert hours == [at("06:00")]
    assert hournotes.load_hours_of_events(spark, database, at("06:00"), at("07:00")) == []
