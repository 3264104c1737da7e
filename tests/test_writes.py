"""Contracts, replace-hour and upsert writes."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import at

from hourmart import schemas
from hourmart.operators import contracts, merge
from hourmart.sources import tables

TEN, ELEVEN, NOON = (f"2024-01-01 {h}:00:00" for h in (10, 11, 12))
TOP = schemas.DM_TOP10_PAGE
CORE = schemas.CORE_BUY_PRODUCT


def core_rows(spark, *rows):
    """Rows of (click, time); the other columns are filled in."""
    data = [(c, "u", "/product_1", at(t), at(t).replace(minute=0)) for c, t in rows]
    return spark.createDataFrame(data, CORE.schema)


def top_rows(spark, *rows):
    return spark.createDataFrame([(at(t), page, n) for t, page, n in rows], TOP.schema)


def content(spark, spec, database):
    return sorted(tuple(r) for r in tables.read_table(spark, spec, database).collect())


def clicks(spark, database):
    return [row[0] for row in content(spark, CORE, database)]


def test_replace_hours_twice_is_once(spark, database):
    rows = core_rows(spark, ("a", "10:05"), ("b", "11:05"))
    for _ in range(2):
        tables.replace_hours(spark, rows, CORE, TEN, NOON, database)
        assert clicks(spark, database) == ["a", "b"]


def test_hour_that_becomes_empty_is_cleared(spark, database):
    tables.replace_hours(
        spark, core_rows(spark, ("a", "10:05"), ("b", "11:05")), CORE, TEN, NOON, database
    )
    tables.replace_hours(spark, core_rows(spark, ("c", "11:05")), CORE, TEN, NOON, database)
    assert clicks(spark, database) == ["c"]
    tables.replace_hours(
        spark, core_rows(spark, ("x", "10:05")).limit(0), CORE, TEN, NOON, database
    )
    assert clicks(spark, database) == []


def test_replace_leaves_other_hours(spark, database):
    tables.replace_hours(
        spark, core_rows(spark, ("a", "10:05"), ("b", "11:05")), CORE, TEN, NOON, database
    )
    tables.replace_hours(spark, core_rows(spark, ("c", "10:07")), CORE, TEN, ELEVEN, database)
    assert clicks(spark, database) == ["b", "c"]


def test_row_outside_the_range_stops_the_write(spark, database):
    with pytest.raises(Exception, match="outside the hours"):
        tables.replace_hours(spark, core_rows(spark, ("a", "11:05")), CORE, TEN, ELEVEN, database)
    assert clicks(spark, database) == []


def test_broken_contract_leaves_the_table(spark, database):
    tables.replace_hours(spark, core_rows(spark, ("a", "10:05")), CORE, TEN, ELEVEN, database)
    nobody = spark.createDataFrame(
        [("b", None, "/product_1", at("10:06"), at("10:00"))], CORE.schema
    )
    with pytest.raises(Exception, match="user_custom_id: not_null rule broken"):
        tables.replace_hours(spark, nobody, CORE, TEN, ELEVEN, database)
    with pytest.raises(Exception, match="click_id: max_length rule broken"):
        tables.replace_hours(
            spark, core_rows(spark, ("c" * 41, "10:05")), CORE, TEN, ELEVEN, database
        )
    assert clicks(spark, database) == ["a"]


def test_replace_keeps_the_other_hours_of_the_day(spark, database):
    tables.replace_hours(
        spark, top_rows(spark, ("10:00", "/a", 1), ("11:00", "/b", 2)), TOP, TEN, NOON, database
    )
    tables.replace_hours(spark, top_rows(spark, ("11:00", "/c", 3)), TOP, ELEVEN, NOON, database)
    assert content(spark, TOP, database) == [(at("10:00"), "/a", 1), (at("11:00"), "/c", 3)]
    empty = top_rows(spark, ("11:00", "/c", 3)).limit(0)
    tables.replace_hours(spark, empty, TOP, TEN, NOON, database)
    assert content(spark, TOP, database) == []


def test_upsert_updates_inserts_and_keeps_stale_keys(spark, database):
    tables.upsert_hours(
        spark, top_rows(spark, ("10:00", "/a", 1), ("10:00", "/b", 2)), TOP, TEN, ELEVEN, database
    )
    tables.upsert_hours(
        spark, top_rows(spark, ("10:00", "/b", 5), ("10:00", "/c", 3)), TOP, TEN, ELEVEN, database
    )
    assert content(spark, TOP, database) == [
        (at("10:00"), "/a", 1), (at("10:00"), "/b", 5), (at("10:00"), "/c", 3),
    ]
    tables.upsert_hours(
        spark, top_rows(spark, ("10:00", "/a", 1)).limit(0), TOP, TEN, ELEVEN, database
    )
    assert len(content(spark, TOP, database)) == 3


def test_upsert_with_a_doubled_key_stops(spark, database):
    rows = top_rows(spark, ("10:00", "/a", 1), ("10:00", "/a", 2))
    with pytest.raises(Exception, match="unique rule broken"):
        tables.upsert_hours(spark, rows, TOP, TEN, ELEVEN, database)


@pytest.mark.parametrize("write", [tables.replace_hours, tables.upsert_hours])
def test_hours_of_one_day_written_side_by_side(spark, database, write):
    tables.ensure_table(spark, TOP, database)
    hours = [f"{h:02d}" for h in range(4, 8)]

    def one(hour):
        end = f"2024-01-01 {int(hour) + 1:02d}:00:00"
        rows = top_rows(spark, (f"{hour}:00", f"/{hour}", 1))
        write(spark, rows, TOP, f"2024-01-01 {hour}:00:00", end, database)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(one, hours))
    spark.catalog.refreshTable(f"{database}.{TOP.name}")
    assert [page for _, page, _ in content(spark, TOP, database)] == [f"/{h}" for h in hours]


def test_upserts_of_one_hour_side_by_side_lose_nothing(spark, database):
    tables.ensure_table(spark, TOP, database)

    def one(page):
        for n in (1, 2):
            rows = top_rows(spark, ("10:00", page, n))
            tables.upsert_hours(spark, rows, TOP, TEN, ELEVEN, database)

    pages = [f"/{n}" for n in range(4)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(one, pages))
    spark.catalog.refreshTable(f"{database}.{TOP.name}")
    assert content(spark, TOP, database) == [(at("10:00"), page, 2) for page in pages]


@pytest.mark.parametrize("stored", [(), ("/old",)])
def test_upsert_merges_again_after_a_foreign_write(spark, database, monkeypatch, stored):
    if stored:
        rows = top_rows(spark, *[("10:00", page, 1) for page in stored])
        tables.replace_hours(spark, rows, TOP, TEN, ELEVEN, database)
    merges = []

    def slow_merge(target, updates, key):
        merged = merge.upsert(target, updates, key)
        if not merges:
            # Another application's write: it does not take turns with ours.
            foreign = [("10:00", page, 1) for page in (*stored, "/foreign")]
            tables.overwrite_partitions(spark, top_rows(spark, *foreign), TOP, database)
        merges.append(merged)
        return merged

    monkeypatch.setattr(tables, "upsert", slow_merge)
    tables.upsert_hours(spark, top_rows(spark, ("10:00", "/own", 3)), TOP, TEN, ELEVEN, database)
    assert len(merges) == 2
    pages = [page for _, page, _ in content(spark, TOP, database)]
    assert pages == sorted(("/foreign", *stored, "/own"))


def test_upsert_gives_up_when_others_never_stop(spark, database, monkeypatch):
    tables.replace_hours(spark, top_rows(spark, ("10:00", "/a", 1)), TOP, TEN, ELEVEN, database)
    names = iter(range(100))
    monkeypatch.setattr(tables, "ATTEMPTS", 2)
    monkeypatch.setattr(tables, "_files", lambda *_: {next(names)})
    with pytest.raises(RuntimeError, match="kept changing"):
        tables.upsert_hours(spark, top_rows(spark, ("10:00", "/b", 1)), TOP, TEN, ELEVEN, database)
    monkeypatch.undo()
    assert content(spark, TOP, database) == [(at("10:00"), "/a", 1)]


def test_replace_range_is_guarded_like_a_write(spark):
    rows = top_rows(spark, ("10:00", "/a", 1))
    with pytest.raises(Exception, match="outside the hours"):
        merge.replace_range(rows, rows, "event_timestamp", ELEVEN, NOON).collect()


def test_no_write_without_dynamic_overwrite(spark, database):
    tables.replace_hours(spark, core_rows(spark, ("a", "10:05")), CORE, TEN, ELEVEN, database)
    key = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(key, "static")
    try:
        with pytest.raises(RuntimeError, match="dynamic"):
            tables.replace_hours(spark, core_rows(spark, ("b", "11:05")), CORE, ELEVEN, NOON, database)
    finally:
        spark.conf.set(key, "dynamic")
    assert clicks(spark, database) == ["a"]


def test_pure_merges(spark):
    target = top_rows(spark, ("10:00", "/a", 1), ("11:00", "/a", 1))
    updates = target.filter("hour(event_timestamp) = 11").selectExpr(
        "event_timestamp", "page_url_path", "count_page_url_path + 6 AS count_page_url_path"
    )
    merged = merge.upsert(target, updates, list(TOP.key))
    assert sorted(map(tuple, merged.collect())) == [(at("10:00"), "/a", 1), (at("11:00"), "/a", 7)]
    swapped = merge.replace_range(target, updates, "event_timestamp", ELEVEN, NOON)
    assert sorted(map(tuple, swapped.collect())) == sorted(map(tuple, merged.collect()))


def test_violations_report(spark):
    rows = spark.createDataFrame(
        [("c" * 41, None, "/p", at("10:00"), at("10:00")), ("c", "u", None, None, None)],
        CORE.schema,
    )
    report = {
        (r.rule, r.column_name): r.violations
        for r in contracts.violations(rows, CORE).collect()
    }
    assert report == {
        ("not_null", "click_id"): 0,
        ("not_null", "user_custom_id"): 1,
        ("not_null", "page_url_path"): 1,
        ("not_null", "event_timestamp"): 1,
        ("max_length", "click_id"): 1,
        ("max_length", "user_custom_id"): 0,
    }
    doubled = top_rows(spark, ("10:00", "/a", 1), ("10:00", "/a", 2), ("10:00", "/b", 1))
    found = {r.rule: r.violations for r in contracts.violations(doubled, TOP).collect()}
    assert found["unique"] == 1
    assert contracts.duplicate_keys(doubled, list(TOP.key)).first().row_count == 2


def test_tables_keep_their_layout(spark, database):
    tables.ensure_table(spark, schemas.STAGING["browser_events"], database)
    tables.ensure_table(spark, schemas.STAGING["browser_events"], database)
    fields = spark.table(f"{database}.browser_events").columns
    assert fields[-3:] == [schemas.EVENT_TIME_INDEX, "dt", "hr"]
    for spec in (*schemas.RAW, *schemas.CORE, *schemas.MARTS):
        tables.ensure_table(spark, spec, database)
        assert tables.read_table(spark, spec, database).columns == spec.names
