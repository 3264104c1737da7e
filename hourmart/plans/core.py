"""Core layer: purchase chains and payment confirmations.

The hour is part of every window group, so a chain never crosses an hour edge
and one pass over a range equals hour-by-hour runs. Events at one instant are
ordered by their remaining columns.

``split_rows`` is the size from which a window group is split, counted with all
pages of an event, as the windows see it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourmart.functions import (
    bucket,
    funnel_score,
    in_range,
    is_product_like,
    leads_to_purchase,
    round_to_second,
)
from hourmart.functions.pages import CONFIRMATION, PAYMENT
from hourmart.functions.timebuckets import HOUR, Moment
from hourmart.operators.dedupe import distinct_pairs
from hourmart.operators.neighbours import (
    SPLIT_ROWS,
    Neighbours,
    find_hot_groups_of_join,
    place_in_slots,
    within_groups,
    without_groups,
)
from hourmart.operators.prefilter import keep_matching

EVENT_HOUR = "event_hour"


@dataclass(frozen=True)
class _Events:
    """Browser events of a range, and their number if the range leaves any out."""

    rows: DataFrame
    counted: int | None

    def matching(self, history: DataFrame, key: str, value: str) -> DataFrame:
        """(key, value) of a whole history; a run over a range that holds few events
        cuts the history to their keys."""
        pairs = history.select(key, value)
        if self.counted is not None:
            pairs = keep_matching(pairs, self.rows, key, self.counted)
        return pairs

    def lookup(self, history: DataFrame, key: str, value: str) -> DataFrame:
        """The same, copies removed before the join: one click or event may be
        stored under many load hours."""
        return distinct_pairs(self.matching(history, key, value), key, value)


def _events(
    browser: DataFrame,
    columns: list[str],
    start: Moment | None,
    end: Moment | None,
    grain: str,
) -> _Events:
    rows = (
        in_range(browser, "event_timestamp", start, end)
        .select(*columns)
        .withColumn(EVENT_HOUR, bucket("event_timestamp", grain))
    )
    bounded = start is not None or end is not None
    return _Events(rows, rows.count() if bounded else None)


def _rows_of(rows: DataFrame, group: list[str]) -> DataFrame:
    return rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))


def _most_pages(paged: DataFrame) -> DataFrame:
    """How many rows an event can become at most by the join with its pages, copies and all."""
    return paged.groupBy("event_id").agg(F.count(F.lit(1)).alias("w"))


# --- purchase chains ---------------------------------------------------------

CHAIN_GROUP = [EVENT_HOUR, "click_id"]
CHAIN_ORDER = ["event_timestamp", "event_id", "page_url_path", "event_type"]
CHAIN_COLUMNS = [EVENT_HOUR, "click_id", *CHAIN_ORDER]


def _next_pages(views: DataFrame) -> DataFrame:
    following = Neighbours(CHAIN_GROUP, CHAIN_ORDER).shift(
        views, "page_url_path", 1, "next_url_path"
    )
    return following.filter(leads_to_purchase(F.col("page_url_path"), F.col("next_url_path")))


def _bought_views(views: DataFrame) -> DataFrame:
    """Plain way: one shuffle by hour and click serves the removal of copies and
    both windows."""
    placed = views.repartition(*CHAIN_GROUP).dropDuplicates(CHAIN_COLUMNS)
    steps = _next_pages(placed)
    click = Window.partitionBy(*CHAIN_GROUP)
    confirmed = F.max(F.when(F.col("next_url_path") == CONFIRMATION, 1).otherwise(0)).over(click)
    flagged = steps.withColumn("has_confirmation", confirmed)
    return flagged.filter(is_product_like(F.col("page_url_path")) & (F.col("has_confirmation") == 1))


def _bought_views_of_hot_clicks(views: DataFrame, hot_rows: int, split_rows: int) -> DataFrame:
    """Slot way."""
    unique = views.select(*CHAIN_COLUMNS).distinct()
    placed = place_in_slots(unique, CHAIN_GROUP, CHAIN_ORDER, hot_rows, split_rows)
    steps = _next_pages(placed)
    confirmed = steps.filter(F.col("next_url_path") == CONFIRMATION).select(*CHAIN_GROUP).distinct()
    products = steps.filter(is_product_like(F.col("page_url_path")))
    flags = confirmed.withColumnsRenamed({key: f"_c_{key}" for key in CHAIN_GROUP})
    same = [F.col(key).eqNullSafe(F.col(f"_c_{key}")) for key in CHAIN_GROUP]
    return products.join(flags, same[0] & same[1], "left_semi")


def core_buy_product(
    browser: DataFrame,
    location: DataFrame,
    device: DataFrame,
    start: Moment | None = None,
    end: Moment | None = None,
    grain: str = HOUR,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """Product views whose next page is a purchase step, in clicks that reached
    the confirmation within the hour. Reads the raw tables.

    Every user of a click shares all rows of that click, so the next page and
    the confirmation depend on the click alone: users are joined last, to the
    few bought views instead of to every event.
    """
    columns = ["event_id", "click_id", "event_timestamp", "event_type"]
    found = _events(browser, columns, start, end, grain)
    events = found.rows
    paged = found.matching(location, "event_id", "page_url_path")
    pages = distinct_pairs(paged, "event_id", "page_url_path")
    users = found.lookup(device, "click_id", "user_custom_id")
    counts = _rows_of(events, CHAIN_GROUP)
    hot = find_hot_groups_of_join(
        counts,
        _most_pages(paged),
        lambda found: _rows_of(
            within_groups(events, found, CHAIN_GROUP).join(pages, "event_id"), CHAIN_GROUP
        ),
        CHAIN_GROUP,
        split_rows,
    )

    if hot.keys is None:
        bought = _bought_views(events.join(pages, "event_id"))
    else:
        plain = without_groups(events, hot, CHAIN_GROUP).join(pages, "event_id")
        large = within_groups(events, hot, CHAIN_GROUP).join(pages, "event_id")
        bought = _bought_views(plain).select(*CHAIN_COLUMNS).unionByName(
            _bought_views_of_hot_clicks(large, hot.rows, split_rows).select(*CHAIN_COLUMNS)
        )
    return bought.join(users, "click_id", "left").select(
        "click_id",
        "user_custom_id",
        "page_url_path",
        round_to_second(F.col("event_timestamp")).alias("event_timestamp"),
        EVENT_HOUR,
    )


# --- payment funnel ----------------------------------------------------------

FUNNEL_GROUP = [EVENT_HOUR, "user_custom_id"]
FUNNEL_ORDER = ["event_timestamp", "event_id", "click_id", "page_path"]
FUNNEL_COLUMNS = [EVENT_HOUR, "user_custom_id", *FUNNEL_ORDER]


def _funnel_rows(
    browser: DataFrame,
    device: DataFrame,
    location: DataFrame,
    start: Moment | None,
    end: Moment | None,
    grain: str,
    split_rows: int,
) -> list[DataFrame]:
    """Distinct events with user and page, ready for windows: the plain groups,
    and the hot ones placed in slots if there are any."""
    columns = ["event_id", "click_id", "event_timestamp"]
    found = _events(browser, columns, start, end, grain)
    events = found.rows
    users = found.lookup(device, "click_id", "user_custom_id")
    paged = found.matching(location, "event_id", "page_url_path")
    pages = distinct_pairs(paged, "event_id", "page_url_path").withColumnRenamed(
        "page_url_path", "page_path"
    )
    # Counted by click before the users are joined: a click has few rows then.
    clicks = _rows_of(events, [EVENT_HOUR, "click_id"])
    counts = (
        clicks.join(users, "click_id", "left").groupBy(*FUNNEL_GROUP).agg(F.sum("n").alias("n"))
    )

    def with_page(rows: DataFrame) -> DataFrame:
        return rows.join(pages, "event_id", "left").select(*FUNNEL_COLUMNS)

    with_user = events.join(users, "click_id", "left")
    hot = find_hot_groups_of_join(
        counts,
        _most_pages(paged),
        lambda found: _rows_of(with_page(within_groups(with_user, found, FUNNEL_GROUP)), FUNNEL_GROUP),
        FUNNEL_GROUP,
        split_rows,
    )
    if hot.keys is None:
        plain = with_page(with_user)
        return [plain.repartition(*FUNNEL_GROUP).dropDuplicates(FUNNEL_COLUMNS)]
    plain = with_page(without_groups(with_user, hot, FUNNEL_GROUP))
    large = with_page(within_groups(with_user, hot, FUNNEL_GROUP)).distinct()
    return [
        plain.repartition(*FUNNEL_GROUP).dropDuplicates(FUNNEL_COLUMNS),
        place_in_slots(large, FUNNEL_GROUP, FUNNEL_ORDER, hot.rows, split_rows),
    ]


def _union(parts: list[DataFrame]) -> DataFrame:
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


# The columns of the funnel's moves.
STEP_COLUMNS = [
    "click_id", "event_timestamp", "user_custom_id", "page_path", "lead_page_path", "score",
    "lead_score", "diff", "check_conf", "lag_product", EVENT_HOUR,
]


def _steps(rows: DataFrame) -> DataFrame:
    near = Neighbours(FUNNEL_GROUP, FUNNEL_ORDER)
    paged = near.shift(rows, "page_path", 1, "lead_page_path")
    scored = paged.withColumn("score", funnel_score(F.col("page_path"), F.col("lead_page_path")))
    moves = near.shift(scored.filter("score != 0"), "score", 1, "lead_score")
    paid = (F.col("lead_page_path") == CONFIRMATION) & (F.col("score") == 3)
    compared = moves.withColumns(
        {
            "diff": F.col("lead_score") - F.col("score"),
            "check_conf": F.when(paid, 1).otherwise(0),
        }
    )
    changed = compared.filter("diff != 0 OR check_conf = 1")
    return near.shift(changed, "page_path", -2, "lag_product").select(*STEP_COLUMNS)


def funnel_steps(
    browser: DataFrame,
    device: DataFrame,
    location: DataFrame,
    start: Moment | None = None,
    end: Moment | None = None,
    grain: str = HOUR,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """Funnel moves per user and hour: scored 1-3, repeats collapsed to the last,
    with the page two moves back. Reads raw browser, staging device and location.
    """
    parts = _funnel_rows(browser, device, location, start, end, grain, split_rows)
    return _union([_steps(part) for part in parts])


def _count_payments(confirmed: DataFrame) -> DataFrame:
    number = F.count(F.lit(1))
    return confirmed.groupBy(F.col(EVENT_HOUR).alias("event_timestamp")).agg(
        number.alias("count_payment"), number.alias("count_confirmation")
    )


def core_payment_confirm(
    browser: DataFrame,
    device: DataFrame,
    location: DataFrame,
    start: Moment | None = None,
    end: Moment | None = None,
    grain: str = HOUR,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """Confirmed payments per hour.

    A funnel move that leads to the confirmation has score 3, and score 3 moves
    are never collapsed, so the count is that of payment views followed by the
    confirmation: one window instead of three.
    """
    near = Neighbours(FUNNEL_GROUP, FUNNEL_ORDER)
    parts = []
    for rows in _funnel_rows(
        browser, device, location, start, end, grain, split_rows
    ):
        paged = near.shift(rows, "page_path", 1, "lead_page_path")
        paid = (F.col("page_path") == PAYMENT) & (F.col("lead_page_path") == CONFIRMATION)
        parts.append(paged.filter(paid).select(EVENT_HOUR))
    return _count_payments(_union(parts))


def payments_from_steps(steps: DataFrame) -> DataFrame:
    """The same count from the full funnel."""
    return _count_payments(steps.filter(F.col("lead_page_path") == CONFIRMATION))
