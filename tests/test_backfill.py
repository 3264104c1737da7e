"""From staging to marts: one pass against hour by hour, and against the queries."""

from __future__ import annotations

from datetime import timedelta

import pytest
from conftest import TESTDATA, at, rows_of
from pyspark.sql import functions as F

from test_landing import put

from hourmart import fixtures, schemas
from hourmart.__main__ import main
from hourmart.plans import core, marts, raw
from hourmart.plans.backfill import backfill
from hourmart.plans.readiness import hours_ready
from hourmart.sources.tables import overwrite_partitions, read_table

SF = str(TESTDATA / "sf0.01")
FIRST, HOURS = at("00:00"), 6


def stage(spark, database):
    """Six hours of the fixture, with a device row for every click."""
    end = FIRST + timedelta(hours=HOURS)
    for feed, rows in fixtures.staging_frames(spark, SF).items():
        if feed == "device_events":
            extra = rows.limit(1).withColumns(
                {"click_id": F.lit("c19"), "user_custom_id": F.lit("u9")}
            )
            rows = rows.unionByName(extra)
        part = rows.filter(F.col("data_partition_ts") < F.lit(str(end)).cast("timestamp_ntz"))
        overwrite_partitions(spark, part, schemas.STAGING[feed], database)
    return end


def tables_of(spark, database):
    return {
        spec.name: rows_of(read_table(spark, spec, database))
        for spec in (*schemas.RAW, *schemas.CORE, *schemas.MARTS)
    }


def test_backfill(spark, database):
    end = stage(spark, database)
    for hour in range(HOURS):
        start = FIRST + timedelta(hours=hour)
        backfill(spark, start, start + timedelta(hours=1), database, marts_mode="upsert")
    by_hour = tables_of(spark, database)
    backfill(spark, FIRST, end, database)
    assert tables_of(spark, database) == by_hour
    assert all(by_hour.values())

    staged = {f: read_table(spark, s, database) for f, s in schemas.STAGING.items()}
    browser = raw.raw_browser_events(staged["browser_events"])
    bought = core.core_buy_product(
        browser,
        raw.raw_location_events(staged["location_events"]),
        raw.raw_device_events(staged["device_events"]),
    )
    payments = core.core_payment_confirm(
        browser, staged["device_events"], staged["location_events"]
    )
    assert rows_of(bought) == by_hour["core_buy_product_table"]
    assert rows_of(payments) == by_hour["core_payment_confirm"]
    assert rows_of(marts.dm_dist_events(bought, payments)) == by_hour["dm_dist_events"]
    assert rows_of(marts.dm_top10_page(bought)) == by_hour["dm_top10_page"]


def test_late_event_joins_its_hour_on_rerun(spark, database):
    stage(spark, database)
    hour = (FIRST, FIRST + timedelta(hours=1))
    backfill(spark, *hour, database)
    before = read_table(spark, schemas.DM_HOURLY_EVENTS, database).first().event_count
    late = fixtures.staging_frames(spark, SF)["browser_events"].limit(1).withColumns(
        {
            "event_id": F.lit("late"),
            "event_timestamp": F.lit("2024-01-01T00:30:00"),
            "data_partition_ts": F.lit("2024-01-02 00:00:00").cast("timestamp_ntz"),
        }
    )
    overwrite_partitions(spark, late, schemas.STAGING["browser_events"], database)
    backfill(spark, *hour, database)
    assert read_table(spark, schemas.DM_HOURLY_EVENTS, database).first().event_count == before + 1
    ids = read_table(spark, schemas.RAW_BROWSER, database).select("event_id")
    assert ids.filter("event_id = 'late'").count() == 1


def test_arguments(spark, database):
    with pytest.raises(ValueError, match="marts_mode"):
        backfill(spark, FIRST, FIRST + timedelta(hours=1), database, marts_mode="append")
    with pytest.raises(ValueError, match="empty range"):
        backfill(spark, FIRST, FIRST, database)
    with pytest.raises(ValueError, match="unknown tables: dm_other"):
        backfill(spark, FIRST, FIRST + timedelta(hours=1), database, tables=["dm_other"])


def test_command_line_lands_and_fills_one_table(spark, tmp_path, database, capsys):
    event = {"event_id": "e", "click_id": "c", "event_timestamp": "2024-01-01 00:10:00"}
    put(tmp_path, "browser_events", 0, {"browser_events.jsonl": [event, event]})
    hour = ["2024-01-01 00:00:00", "2024-01-01 01:00:00"]
    head = ["--database", database]
    main([*head, "land", str(tmp_path), "--feeds", "browser_events", "--start", hour[0],
          "--end", hour[1]])
    main([*head, "backfill", *hour, "--tables", "dm_hourly_events"])
    assert rows_of(read_table(spark, schemas.DM_HOURLY_EVENTS, database)) == [
        ("2", "2024-01-01 00:00:00")
    ]
    assert not spark.catalog.tableExists(f"{database}.raw_browser_events")
    main([*head, "ready", *hour])
    assert "2024-01-01 00:00:00|2 " in capsys.readouterr().out


def test_hours_ready_lists_absent_hours(spark):
    def feed(*times):
        return spark.createDataFrame([(at(t),) for t in times], "data_partition_ts TIMESTAMP_NTZ")

    staging = {
        "browser_events": feed("10:00", "10:00", "12:00"),
        "device_events": feed("10:00", "12:00"),
        "geo_events": feed("10:00"),
        "location_events": feed("10:00", "12:00"),
    }
    bounded = hours_ready(staging, "2024-01-01 10:00:00", "2024-01-01 14:00:00")
    expected = [
        (at("10:00"), 2, 1, 1, 1, True),
        (at("11:00"), 0, 0, 0, 0, False),
        (at("12:00"), 1, 1, 0, 1, False),
        (at("13:00"), 0, 0, 0, 0, False),
    ]
    assert [tuple(r) for r in bounded.orderBy("load_hour").collect()] == expected
    assert [tuple(r) for r in hours_ready(staging).orderBy("load_hour").collect()] == expected[:3]
