"""Objects of any size, objects replaced in place, and readiness from partitions."""

from __future__ import annotations

import os
import re
import zipfile

import pytest
from conftest import at, rows_of
from test_landing import event, put, stored

from hourmart.__main__ import main
from hourmart.plans.readiness import hours_ready, stored_hours_ready
from hourmart.schemas import FEEDS, STAGING
from hourmart.sources import landing, zipmembers
from hourmart.sources.tables import read_table


def test_an_object_beyond_two_gigabytes(spark, tmp_path, database):
    """A sparse file with the archive at its end: no task could hold it as one value."""
    path = put(tmp_path, "browser_events", 10, {"browser_events.jsonl": [event(1), event(2)]})
    archive = path.read_bytes()
    with path.open("wb") as file:
        file.truncate(2_300_000_000)
    with zipfile.ZipFile(path, "a", zipfile.ZIP_DEFLATED) as both:
        both.writestr("browser_events.jsonl", zipfile.ZipFile(_bytes(archive)).read("browser_events.jsonl"))
    assert os.path.getsize(path) > 2**31
    landing.load_browser(spark, str(tmp_path), database=database)
    assert {r.event_id for r in stored(spark, database).collect()} == {"e1", "e2"}


def _bytes(content):
    import io

    return io.BytesIO(content)


def test_members_of_a_large_object_are_tasks_of_their_own(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "LARGE_OBJECT", 1)
    monkeypatch.setattr(zipmembers, "BLOCK_BYTES", 1000)
    rows = [event(n % 60, browser_name=f"имя {n}") for n in range(500)]
    put(tmp_path, "browser_events", 10, {"browser_events.jsonl": rows, "device_events.jsonl": [{"click_id": "c"}]})
    put(tmp_path, "browser_events", 11, {"browser_events.jsonl": []})
    lines = landing.read_lines(spark, str(tmp_path), "browser_events")
    assert lines.rdd.getNumPartitions() >= 3
    assert lines.groupBy("table").count().collect() and lines.count() == 501
    plain = landing.route_members(
        landing.unzip_lines(landing.scan_objects(spark, str(tmp_path), "browser_events"))
    )
    assert rows_of(lines) == rows_of(plain)


def test_only_stores_that_python_opens():
    assert zipmembers.can_open("file:/a/b.zip") and zipmembers.can_open("s3a://bucket/b.zip")
    assert not zipmembers.can_open("viewfs://store/b.zip")


def test_an_object_replaced_in_place_lands_again(spark, tmp_path, database):
    root = str(tmp_path)
    first = put(tmp_path, "browser_events", 10, {"browser_events.jsonl": [event(1)]})
    put(tmp_path, "browser_events", 11, {"browser_events.jsonl": [event(2, 11)]})
    assert landing.load_changed(spark, root, "browser_events", database=database) == 2
    assert landing.load_changed(spark, root, "browser_events", database=database) == 0
    put(tmp_path, "browser_events", 10, {"browser_events.jsonl": [event(9), event(8)]})
    os.utime(first, (2_000_000_000, 2_000_000_000))
    assert landing.load_changed(spark, root, "browser_events", database=database) == 1
    assert {r.event_id for r in stored(spark, database).collect()} == {"e8", "e9", "e2"}
    # What fails is not in the ledger.
    put(tmp_path, "browser_events", 12, {"browser_events.jsonl": "{oops"})
    for _ in range(2):
        with pytest.raises(Exception, match="MALFORMED_RECORD"):
            landing.load_changed(spark, root, "browser_events", database=database)
    put(tmp_path, "browser_events", 12, {"browser_events.jsonl": [event(3, 12)]})
    main(["--database", database, "land-changed", root, "--feeds", "browser_events"])
    assert stored(spark, database).count() == 4


def test_readiness_reads_no_column(spark, tmp_path, database):
    put(tmp_path, "browser_events", 10, {"browser_events.jsonl": [event(1), event(2)]})
    put(tmp_path, "geo_events", 11, {"geo_events.jsonl": [{"click_id": "c"}]})
    for load in (landing.load_browser, landing.load_geo):
        load(spark, str(tmp_path), database=database)
    bounds = ("2024-01-01 09:00:00", "2024-01-01 12:00:00")
    report = stored_hours_ready(spark, *bounds, database)
    staged = {f: read_table(spark, STAGING[f], database, *bounds) for f in FEEDS}
    assert rows_of(report) == rows_of(hours_ready(staged, *bounds))
    assert [r.browser_events for r in report.orderBy("load_hour").collect()] == [0, 2, 0]
    text = report._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"ReadSchema: struct<([^>]*)>", text)) == {""}
    assert text.count("PartitionFilters: [isnotnull(dt") == 4
    assert at("09:00") in {r.load_hour for r in report.collect()}
