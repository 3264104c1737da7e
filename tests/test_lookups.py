"""Tables in buckets of their lookup key: same rows, less read and shuffled."""

from __future__ import annotations

import re
from datetime import timedelta

import pytest
from conftest import TESTDATA, at, rows_of
from pyspark.sql import functions as F

from hourmart import fixtures, schemas
from hourmart.plans import core
from hourmart.plans.backfill import backfill
from hourmart.sources.tables import BUCKETS, overwrite_partitions, read_table
from test_plans import conf, exchanges, plan

SF = str(TESTDATA / "sf0.001")
END = "2024-01-01 12:00:00"


def filled(spark, database):
    for feed, rows in fixtures.staging_frames(spark, SF).items():
        if feed == "device_events":
            known = {"click_id": F.lit("c19"), "user_custom_id": F.lit("u9")}
            rows = rows.unionByName(rows.limit(1).withColumns(known))
        part = rows.filter(f"data_partition_ts < TIMESTAMP_NTZ'{END}'")
        overwrite_partitions(spark, part, schemas.STAGING[feed], database)
    backfill(spark, "2024-01-01 00:00:00", END, database)


@pytest.fixture(scope="module")
def bucketed(spark):
    for name, settings in (("flat", {}), ("bucketed", {BUCKETS: "4"})):
        spark.sql(f"CREATE DATABASE {name}")
        with conf(spark, settings):
            filled(spark, name)
    yield lambda spec, *bounds: read_table(spark, spec, "bucketed", *bounds)
    for name in ("flat", "bucketed"):
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_buckets_hold_the_same_rows(spark, bucketed):
    for spec in (*schemas.STAGING.values(), *schemas.RAW, *schemas.CORE, *schemas.MARTS):
        assert rows_of(bucketed(spec)) == rows_of(read_table(spark, spec, "flat")), spec.name
    described = {r[0]: r[1] for r in spark.sql("DESCRIBE FORMATTED bucketed.raw_location_events").collect()}
    assert described["Num Buckets"] == "4" and "event_id" in described["Sort Columns"]


def test_a_wide_run_joins_history_without_shuffling_it(spark, bucketed):
    with conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(
            core.core_buy_product(
                bucketed(schemas.RAW_BROWSER),
                bucketed(schemas.RAW_LOCATION),
                bucketed(schemas.RAW_DEVICE),
            )
        )
        payments = plan(
            core.core_payment_confirm(
                bucketed(schemas.RAW_BROWSER),
                bucketed(schemas.STAGING["device_events"]),
                bucketed(schemas.STAGING["location_events"]),
            )
        )
    # Pages: neither the removal of copies nor the join moves the history or the events.
    assert not [kind for kind in exchanges(text) if "event_id" in kind.split("ENSURE")[0].split(")")[0]]
    assert not [kind for kind in exchanges(text) if "hashpartitioning(click_id" in kind and "user" in kind]
    assert len(exchanges(text)) <= 3
    below = payments[payments.index("Join") :]
    assert "Bucketed: true" in below


def test_a_narrow_run_names_its_keys_to_the_scan(spark, bucketed):
    hour = ("2024-01-01 10:00:00", "2024-01-01 11:00:00")
    history = [bucketed(s) for s in (schemas.RAW_LOCATION, schemas.RAW_DEVICE)]
    events = bucketed(schemas.RAW_BROWSER, *hour)
    assert 0 < events.count() < 10
    text = plan(core.core_buy_product(events, *history, *hour))
    assert re.search(r"PushedFilters: \[[^\]]*In\(event_id", text)
    read = [int(n) for n in re.findall(r"SelectedBucketsCount: (\d+) out of 4", text)]
    assert read and min(read) < 4
    assert rows_of(core.core_buy_product(events, *history, *hour)) == [
        row for row in rows_of(bucketed(schemas.CORE_BUY_PRODUCT)) if " 10:" in row[1]
    ]


def test_replacing_an_hour_withdraws_its_pairs(spark, bucketed):
    with conf(spark, {BUCKETS: "4"}):
        spec = schemas.RAW_LOCATION
        before = bucketed(spec).count()
        hour = (at("03:00"), at("03:00") + timedelta(hours=1))
        own = bucketed(spec, *hour)
        gone = own.count()
        assert gone
        fewer = spark.createDataFrame(own.limit(1).collect(), spec.schema)
        overwrite_partitions(spark, fewer, spec, "bucketed")
        assert bucketed(spec).count() == before - gone + 1
        backfill(spark, *hour, "bucketed", tables=[spec.name])
        assert bucketed(spec).count() == before
