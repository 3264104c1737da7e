"""Chains and funnels on hand-made and random rows, plain and split."""

from __future__ import annotations

import random
from datetime import timedelta

import brute
import pytest
from conftest import at

from hourmart.operators import neighbours
from hourmart.plans import core, marts

BROWSER = "event_id STRING, click_id STRING, event_timestamp TIMESTAMP_NTZ, event_type STRING"
LOCATION = "event_id STRING, page_url_path STRING"
DEVICE = "click_id STRING, user_custom_id STRING"


def names(schema):
    return [part.split()[0] for part in schema.split(", ")]


class Shop:
    def __init__(self):
        self.browser, self.location, self.device = [], [], []

    def visit(self, event, click, time, page, kind="pageview"):
        self.browser.append((event, click, at(time) if isinstance(time, str) else time, kind))
        self.location.append((event, page))
        return self

    def user(self, click, user):
        self.device.append((click, user))
        return self

    def frames(self, spark):
        return (
            spark.createDataFrame(self.browser, BROWSER),
            spark.createDataFrame(self.location, LOCATION),
            spark.createDataFrame(self.device, DEVICE),
        )

    def dicts(self):
        return (
            [dict(zip(names(BROWSER), row)) for row in self.browser],
            [dict(zip(names(LOCATION), row)) for row in self.location],
            [dict(zip(names(DEVICE), row)) for row in self.device],
        )

    def bought(self, spark, **options):
        browser, location, device = self.frames(spark)
        return core.core_buy_product(browser, location, device, **options)

    def steps(self, spark, **options):
        browser, location, device = self.frames(spark)
        return core.funnel_steps(browser, device, location, **options)

    def payments(self, spark, **options):
        browser, location, device = self.frames(spark)
        return core.core_payment_confirm(browser, device, location, **options)


def text(rows):
    return sorted(tuple(str(value) for value in row) for row in rows)


def random_shop(seed, events=400, clicks=4):
    """Few clicks and coarse times: ties, repeats, NULL users and keys, copies."""
    rng = random.Random(seed)
    pages = ["/product_1", "/product_2", "/products", "/product", "/cart", "/payment",
             "/confirmation", "/home", None]
    shop = Shop()
    for number in range(events):
        click = rng.choice([f"c{n}" for n in range(clicks)] + [None] * (rng.random() < 0.1))
        time = at("10:00") + timedelta(seconds=rng.choice([0, 0.6, 1]) + rng.randrange(7000))
        if rng.random() < 0.3:
            time = time.replace(minute=5, second=0, microsecond=0)
        event = f"e{rng.randrange(events * 10):05d}"
        shop.visit(event, click, time, rng.choice(pages), rng.choice(["a", "b"]))
        if rng.random() < 0.1:
            shop.visit(event, click, time, shop.location[-1][1], "a")
    for click, user in [("c0", "u1"), ("c0", "u2"), ("c1", "u1"), ("c1", "u1"), (None, "u9")]:
        shop.user(click, user)
    return shop


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("split_rows", [10_000, 20])
def test_random_rows_against_brute_force(spark, seed, split_rows):
    shop = random_shop(seed)
    browser, location, device = shop.dicts()
    bought = shop.bought(spark, split_rows=split_rows)
    assert text(bought.collect()) == text(brute.buy_product(browser, location, device))
    steps = shop.steps(spark, split_rows=split_rows)
    assert steps.columns == core.STEP_COLUMNS
    expected = brute.funnel(browser, device, location)
    assert text(steps.collect()) == text(expected)
    assert expected
    short = shop.payments(spark, split_rows=split_rows)
    assert text(short.collect()) == text(core.payments_from_steps(steps).collect())


def test_one_hot_user_is_cut_into_slots(spark):
    """A third of all rows have no user; all of them at one instant."""
    shop = Shop().user("c1", "u1").user("c2", "u2")
    pages = ["/product_1", "/cart", "/payment", "/confirmation"]
    for number in range(300):
        click = ["c1", "c2", "lost"][number % 3]
        time = "10:30:00" if click == "lost" else f"10:{number % 60:02d}:00"
        shop.visit(f"e{number:04d}", click, time, pages[number // 3 % 4])
    browser, location, device = shop.dicts()
    frame = shop.steps(spark, split_rows=90)
    assert text(frame.collect()) == text(brute.funnel(browser, device, location))

    rows = spark.createDataFrame(
        [("g", n, f"v{n}") for n in range(100)], "g STRING, n INT, v STRING"
    )
    placed = neighbours.place_in_slots(rows, ["g"], ["n"], 100, split_rows=10)
    sizes = [row["count"] for row in placed.groupBy(neighbours.SLOT).count().collect()]
    assert len(sizes) > 10 and max(sizes) <= 20
    near = neighbours.Neighbours(["g"], ["n"])
    for step in (1, -1, -2, 3):
        got = {row.n: row.x for row in near.shift(placed, "v", step, "x").collect()}
        assert got == {n: f"v{n + step}" if 0 <= n + step < 100 else None for n in range(100)}


def test_hot_groups_are_found_by_count(spark):
    counts = spark.createDataFrame([("a", 5), (None, 50), ("b", 60)], "g STRING, n LONG")
    hot = neighbours.find_hot_groups(counts, ["g"], split_rows=50)
    assert {row.g for row in hot.keys.collect()} == {None, "b"}
    assert (hot.number, hot.rows) == (2, 110)
    assert neighbours.find_hot_groups(counts, ["g"], split_rows=61).keys is None
    assert neighbours.find_hot_groups(counts.limit(0), ["g"], split_rows=1).keys is None


def test_more_hot_groups_than_a_broadcast_holds_are_all_split(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LISTED_GROUPS", 1)
    placed = []
    place = core.place_in_slots
    monkeypatch.setattr(core, "place_in_slots", lambda *a: placed.append(place(*a)) or placed[-1])
    shop = random_shop(3)
    browser, location, device = shop.dicts()
    bought = shop.bought(spark, split_rows=20)
    assert text(bought.collect()) == text(brute.buy_product(browser, location, device))
    steps = shop.steps(spark, split_rows=20)
    assert text(steps.collect()) == text(brute.funnel(browser, device, location))
    groups = [p.select(*k).distinct().count() for p, k in zip(placed, (core.CHAIN_GROUP, core.FUNNEL_GROUP))]
    assert len(groups) == 2 and min(groups) > 1


def test_an_event_with_many_pages_makes_its_group_hot(spark, monkeypatch):
    """One view, 60 pages: the window sees 60 rows."""
    shop = Shop().user("c", "u")
    shop.visit("e", "c", "10:00:00", "/product_1")
    for number in range(59):
        shop.location.append(("e", f"/product_{number + 2}"))
    shop.visit("f", "c", "10:01:00", "/confirmation")
    browser, location, device = shop.dicts()
    calls = []
    place = core.place_in_slots
    monkeypatch.setattr(core, "place_in_slots", lambda *a: calls.append(1) or place(*a))
    bought = shop.bought(spark, split_rows=50)
    assert text(bought.collect()) == text(brute.buy_product(browser, location, device))
    steps = shop.steps(spark, split_rows=50)
    assert text(steps.collect()) == text(brute.funnel(browser, device, location))
    assert len(calls) == 2


def test_chain_does_not_cross_the_hour(spark):
    shop = Shop().user("c", "u")
    shop.visit("1", "c", "10:59:00", "/product_1").visit("2", "c", "11:01:00", "/confirmation")
    assert shop.bought(spark).collect() == []
    assert shop.bought(spark, grain="day").count() == 1


def test_rounding_over_the_hour_edge_keeps_the_hour(spark):
    shop = Shop().user("c", "u")
    shop.visit("1", "c", "10:59:59.600", "/product_1")
    shop.visit("2", "c", "10:59:59.900", "/confirmation")
    bought = shop.bought(spark)
    row = bought.first()
    assert (row.event_timestamp, row.event_hour) == (at("11:00"), at("10:00"))
    assert marts.dm_buy_product(bought).first().event_timestamp == at("10:00")


def test_tied_times_follow_the_event_id(spark):
    shop = Shop().user("c", "u")
    shop.visit("2", "c", "10:00:00", "/confirmation").visit("1", "c", "10:00:00", "/product_1")
    assert [row.page_url_path for row in shop.bought(spark).collect()] == ["/product_1"]


def test_click_without_device_keeps_its_row(spark):
    shop = Shop().user("other", "u")
    shop.visit("1", "c", "10:00:00", "/product_1").visit("2", "c", "10:00:01", "/confirmation")
    assert shop.bought(spark).first().user_custom_id is None


def test_repeated_step_collapses_to_the_last(spark):
    shop = Shop().user("c", "u")
    path = ["/product_1", "/cart", "/product_2", "/cart", "/payment", "/confirmation"]
    for number, page in enumerate(path):
        shop.visit(str(number), "c", f"10:00:0{number}", page)
    steps = shop.steps(spark).orderBy("event_timestamp").collect()
    assert [(s.page_path, s.score, s.lead_score, s.diff, s.check_conf) for s in steps] == [
        ("/product_2", 1, 2, 1, 0),
        ("/cart", 2, 3, 1, 0),
        ("/payment", 3, None, None, 1),
    ]
    assert [s.lag_product for s in steps] == [None, None, "/product_2"]
    assert shop.payments(spark).collect() == [(at("10:00"), 1, 1)]


def test_user_of_several_clicks_has_one_funnel_but_separate_chains(spark):
    shop = Shop().user("a", "u").user("b", "u")
    shop.visit("1", "a", "10:00:00", "/payment").visit("2", "b", "10:00:01", "/confirmation")
    shop.visit("3", "a", "10:00:02", "/product_1").visit("4", "b", "10:00:03", "/confirmation")
    assert shop.payments(spark).first().count_payment == 1
    assert shop.bought(spark).collect() == []


def test_range_equals_hour_by_hour(spark):
    shop = random_shop(5)
    hours = [("2024-01-01 10:00:00", "2024-01-01 11:00:00"),
             ("2024-01-01 11:00:00", "2024-01-01 12:00:00")]
    whole = (hours[0][0], hours[1][1])
    for build in (shop.bought, shop.steps, shop.payments):
        once = text(build(spark, start=whole[0], end=whole[1]).collect())
        parts = [row for lo, hi in hours for row in build(spark, start=lo, end=hi).collect()]
        assert once == text(parts) == text(build(spark).collect())


def test_top_ten_breaks_ties_by_page(spark):
    rows = [(at("10:00"), f"/product_{n:02d}") for n in range(12)]
    rows += [(at("11:00"), "/product_99")] * 2
    frame = spark.createDataFrame(rows, "event_hour TIMESTAMP_NTZ, page_url_path STRING")
    found = marts.dm_top10_page(frame).orderBy("event_timestamp", "page_url_path").collect()
    assert [row.page_url_path for row in found] == [f"/product_{n:02d}" for n in range(10)] + [
        "/product_99"
    ]
    assert found[-1].count_page_url_path == 2


def test_dist_events_without_payments_are_null(spark):
    frame = spark.createDataFrame(
        [(at("10:00"), "/product_1")], "event_hour TIMESTAMP_NTZ, page_url_path STRING"
    )
    paid = spark.createDataFrame(
        [(at("11:00"), 1, 1)],
        "event_timestamp TIMESTAMP_NTZ, count_payment LONG, count_confirmation LONG",
    )
    assert marts.dm_dist_events(frame, paid).collect() == [(at("10:00"), 1, None, None)]
