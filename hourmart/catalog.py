"""The registered queries and, for each, the SQL another engine can check it by.

The oracles are written from the definition of each result, not from our plans: they
hold all views of a group in one sorted list and find neighbours by place in it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmart import fixtures, schemas
from hourmart.operators.contracts import violations
from hourmart.operators.merge import replace_range, upsert
from hourmart.plans import core, marts, raw
from hourmart.plans.backfill import computed
from hourmart.plans.readiness import hours_ready
from hourmart.sources.landing import parse_feed, route_members, unzip_lines, with_load_hour

Query = Callable[[SparkSession, str], DataFrame]


_RAW = {
    "browser": raw.raw_browser_events,
    "device": raw.raw_device_events,
    "geo": raw.raw_geo_events,
    "location": raw.raw_location_events,
}


def _raw(staging: Mapping[str, DataFrame], name: str) -> DataFrame:
    return _RAW[name](staging[f"{name}_events"])


# Groups above this share of all events are split, so that the split way is
# checked on whole tables too: a day holds about 20 clicks and 10 users a 31st.
_CLICK_SHARE = 500
_USER_SHARE = 270


def _sizes(staging: Mapping[str, DataFrame], split_share: int | None) -> dict[str, int]:
    if split_share is None:
        return {}
    return {"split_rows": max(20, staging["browser_events"].count() // split_share)}


def _bought(
    spark: SparkSession,
    sf_dir: str,
    grain: str = "hour",
    split_share: int | None = None,
    **bounds: str,
) -> DataFrame:
    staging = fixtures.staging_frames(spark, sf_dir)
    return core.core_buy_product(
        _raw(staging, "browser"),
        _raw(staging, "location"),
        _raw(staging, "device"),
        grain=grain,
        **_sizes(staging, split_share),
        **bounds,
    )


def _funnel(
    build: Callable[..., DataFrame],
    spark: SparkSession,
    sf_dir: str,
    grain: str = "hour",
    split_share: int | None = None,
) -> DataFrame:
    staging = fixtures.staging_frames(spark, sf_dir)
    return build(
        raw.raw_browser_events(staging["browser_events"]),
        staging["device_events"],
        staging["location_events"],
        grain=grain,
        **_sizes(staging, split_share),
    )


_payments = partial(_funnel, core.core_payment_confirm)
_steps = partial(_funnel, core.funnel_steps)


def _raw_query(name: str) -> Query:
    return lambda spark, sf_dir: _raw(fixtures.staging_frames(spark, sf_dir), name)


def _hourly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dm_hourly_events(fixtures.staging_frames(spark, sf_dir)["browser_events"])


def _dist_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dm_dist_events(_bought(spark, sf_dir), _payments(spark, sf_dir))


def _landed(feed: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        packed = fixtures.zipped_objects(fixtures.staging_frames(spark, sf_dir)[feed], feed)
        hour = F.col(schemas.LOAD_HOUR)
        objects = packed.select(
            F.year(hour).alias("year"),
            F.month(hour).alias("month"),
            F.day(hour).alias("day"),
            F.hour(hour).alias("hour"),
            "path",
            F.length("content").cast("long").alias("length"),
            "content",
        )
        lines = route_members(unzip_lines(with_load_hour(objects)))
        return parse_feed(lines.filter(F.col("table") == feed), feed)

    return query


def _hours_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hours_ready(fixtures.staging_frames(spark, sf_dir))


def _upsert_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases per hour written over a table with one row a day."""
    devices = fixtures.staging_frames(spark, sf_dir)["device_events"]
    target = devices.groupBy(F.col(schemas.LOAD_HOUR).alias("event_timestamp")).agg(
        F.count(F.lit(1)).alias("count_buy_product")
    )
    updates = marts.dm_buy_product(_bought(spark, sf_dir))
    return upsert(target, updates, list(schemas.DM_BUY_PRODUCT.key))


def _upsert_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hours' top pages written over the days' top pages."""
    target = marts.dm_top10_page(_bought(spark, sf_dir, "day"))
    updates = marts.dm_top10_page(_bought(spark, sf_dir))
    return upsert(target, updates, list(schemas.DM_TOP10_PAGE.key))


_REPLACED = {"start": "2024-01-10 06:00:00", "end": "2024-01-20 18:00:00"}


def _replace_hours_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over part of the month put into an older state of the table."""
    older = _bought(spark, sf_dir).withColumn(
        "page_url_path", F.concat(F.lit("old:"), "page_url_path")
    )
    return replace_range(older, _bought(spark, sf_dir, **_REPLACED), "event_hour", **_REPLACED)


def _backfill_dist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All steps of a backfill over part of the month, down to the last mart."""
    staging = fixtures.staging_frames(spark, sf_dir)
    return computed(spark, staging, **_REPLACED)[schemas.DM_DIST_EVENTS.name]


def _backfill_dist_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All steps of a backfill over every hour of the table, down to the last mart."""
    staging = fixtures.staging_frames(spark, sf_dir)
    at = F.expr("try_cast(event_timestamp AS TIMESTAMP_NTZ)")
    hours = staging["browser_events"].agg(
        F.date_trunc("hour", F.min(at)).cast("string"),
        (F.date_trunc("hour", F.max(at)) + F.expr("INTERVAL 1 HOUR")).cast("string"),
    )
    start, end = hours.first()
    # Without events any range gives the empty mart.
    start, end = (start, end) if start else _REPLACED.values()
    return computed(spark, staging, start, end)[schemas.DM_DIST_EVENTS.name]


def _contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = fixtures.staging_frames(spark, sf_dir)
    bought = _bought(spark, sf_dir)
    checked = [
        (_raw(staging, "browser"), schemas.RAW_BROWSER),
        (_raw(staging, "device"), schemas.RAW_DEVICE),
        (_raw(staging, "geo"), schemas.RAW_GEO),
        (_raw(staging, "location"), schemas.RAW_LOCATION),
        (bought, schemas.CORE_BUY_PRODUCT),
        (marts.dm_top10_page(bought), schemas.DM_TOP10_PAGE),
        # The rounded times of single purchases are no key of a table by hour.
        (
            bought.select("event_timestamp", F.lit(1).alias("count_buy_product")),
            schemas.DM_BUY_PRODUCT,
        ),
    ]
    reports = [violations(rows, spec) for rows, spec in checked]
    return reduce(DataFrame.unionByName, reports)


QUERIES: dict[str, Query] = {
    "land_browser": _landed("browser_events"),
    "land_device": _landed("device_events"),
    "land_geo": _landed("geo_events"),
    "land_location": _landed("location_events"),
    "hours_ready": _hours_ready,
    "raw_browser_events": _raw_query("browser"),
    "raw_device_events": _raw_query("device"),
    "raw_geo_events": _raw_query("geo"),
    "raw_location_events": _raw_query("location"),
    "core_buy_product": _bought,
    "core_buy_product_day": partial(_bought, grain="day"),
    "core_buy_product_split": partial(_bought, grain="day", split_share=_CLICK_SHARE),
    "funnel_steps": _steps,
    "funnel_steps_day": partial(_steps, grain="day"),
    "funnel_steps_split": partial(_steps, grain="day", split_share=_USER_SHARE),
    "core_payment_confirm": _payments,
    "core_payment_confirm_split": partial(_payments, grain="day", split_share=_USER_SHARE),
    "dm_buy_product": lambda s, d: marts.dm_buy_product(_bought(s, d)),
    "dm_top10_page": lambda s, d: marts.dm_top10_page(_bought(s, d)),
    "dm_top10_page_day": lambda s, d: marts.dm_top10_page(_bought(s, d, "day")),
    "dm_hourly_events": _hourly_events,
    "dm_dist_events": _dist_events,
    "replace_hours_result": _replace_hours_result,
    "backfill_dist_events": _backfill_dist,
    "backfill_dist_events_whole": _backfill_dist_whole,
    "upsert_mart": _upsert_mart,
    "upsert_top10": _upsert_top10,
    "contract_violations": _contract_violations,
}

_RAW_SQL = """
raw_browser AS (
  SELECT DISTINCT click_id, event_id, event_timestamp AS event_text, event_type, browser_name,
         browser_language, browser_user_agent
  FROM stg_browser),
raw_browser_events AS (
  SELECT click_id, event_id, cast(event_text AS timestamp) AS event_timestamp, event_type,
         browser_name, browser_language, browser_user_agent
  FROM raw_browser),
raw_device_events AS (SELECT DISTINCT * FROM stg_device),
raw_geo_events AS (SELECT DISTINCT * FROM stg_geo),
raw_location_events AS (SELECT DISTINCT * FROM stg_location)
"""


def _buy_sql(grain: str) -> str:
    """Product views right before a purchase step, of clicks whose trail comes to a
    confirmation after its first view."""
    return f"""
trails AS (
  SELECT date_trunc('{grain}', b.event_timestamp) AS event_hour, b.click_id,
         list_sort(list(DISTINCT {{'at': b.event_timestamp, 'id': b.event_id,
                                   'page': l.page_url_path, 'kind': b.event_type}})) AS trail
  FROM raw_browser_events b JOIN raw_location_events l USING (event_id) GROUP BY ALL),
owners AS (SELECT DISTINCT click_id, user_custom_id FROM raw_device_events),
bought AS (
  SELECT t.click_id, o.user_custom_id, t.trail[i].page AS page_url_path,
         date_trunc('second', t.trail[i].at + INTERVAL '500 milliseconds') AS event_timestamp,
         t.event_hour
  FROM (SELECT *, unnest(range(1, len(trail))) AS i FROM trails
        WHERE list_contains([v.page for v in trail[2:]], '/confirmation')) t
  LEFT JOIN owners o USING (click_id)
  WHERE t.trail[i].page LIKE '/product_%'
    AND t.trail[i + 1].page IN ('/cart', '/payment', '/confirmation'))
"""


def _funnel_sql(grain: str) -> str:
    """Of each user's walk, the places of its moves; of these, the ones that end a run of
    equal scores or confirm; payments straight from adjacent pages."""
    return f"""
walks AS (
  SELECT date_trunc('{grain}', b.event_timestamp) AS event_hour, d.user_custom_id,
         list_sort(list(DISTINCT {{'at': b.event_timestamp, 'id': b.event_id,
                                   'click': b.click_id, 'page': l.page_url_path}})) AS walk
  FROM raw_browser_events b LEFT JOIN stg_device d USING (click_id)
  LEFT JOIN stg_location l USING (event_id) GROUP BY ALL),
pairs AS (
  SELECT *, [coalesce(list_position(['product>/cart', '/cart>/payment', '/payment>/confirmation'],
               concat(CASE WHEN walk[i].page[2:8] = 'product' THEN 'product'
                           ELSE walk[i].page END, '>', walk[i + 1].page)), 0)
             for i in range(1, len(walk))] AS scores
  FROM walks),
places AS (SELECT *, [i for i in range(1, len(walk)) if scores[i] > 0] AS moves FROM pairs),
ends AS (
  SELECT *, [j for j in range(1, len(moves) + 1)
             if scores[moves[j]] = 3
                OR coalesce(scores[moves[j + 1]] <> scores[moves[j]], false)] AS kept
  FROM places),
stepped AS (
  SELECT walk[moves[kept[k]]].click AS click_id, walk[moves[kept[k]]].at AS event_timestamp,
         user_custom_id, walk[moves[kept[k]]].page AS page_path,
         walk[moves[kept[k]] + 1].page AS lead_page_path, scores[moves[kept[k]]] AS score,
         scores[moves[kept[k] + 1]] AS lead_score,
         scores[moves[kept[k] + 1]] - scores[moves[kept[k]]] AS diff,
         (scores[moves[kept[k]]] = 3)::INT AS check_conf,
         CASE WHEN k > 2 THEN walk[moves[kept[k - 2]]].page END AS lag_product, event_hour
  FROM (SELECT *, unnest(range(1, len(kept) + 1)) AS k FROM ends) e),
paid AS (
  SELECT event_hour AS event_timestamp, n AS count_payment, n AS count_confirmation
  FROM (SELECT event_hour, sum(len([i for i in range(1, len(walk))
                 if walk[i].page = '/payment' AND walk[i + 1].page = '/confirmation']))::BIGINT AS n
        FROM walks GROUP BY event_hour) c
  WHERE n > 0)
"""


_TOP10_SQL = """
top10 AS (
  SELECT event_timestamp, page_url_path, count_page_url_path FROM (
    SELECT *, row_number() OVER (PARTITION BY event_timestamp
             ORDER BY count_page_url_path DESC, page_url_path) AS place
    FROM (SELECT event_hour AS event_timestamp, page_url_path,
                 count(page_url_path) AS count_page_url_path
          FROM bought GROUP BY event_hour, page_url_path) c) r
  WHERE place <= 10)
"""

_COUNTED_SQL = """
counted AS (
  SELECT event_hour AS event_timestamp, count(page_url_path) AS count_buy_product
  FROM bought GROUP BY event_hour)
"""


_READY_SQL = """
loads AS (
  SELECT data_partition_ts AS load_hour, 'b' AS feed FROM stg_browser
  UNION ALL SELECT data_partition_ts, 'd' FROM stg_device
  UNION ALL SELECT data_partition_ts, 'g' FROM stg_geo
  UNION ALL SELECT data_partition_ts, 'l' FROM stg_location),
hours AS (
  SELECT unnest(generate_series(min(load_hour), max(load_hour), INTERVAL 1 HOUR)) AS load_hour
  FROM loads)
"""


def _day_top10() -> str:
    """The top ten of the days, next to that of the hours."""
    return _renamed(_buy_sql("day") + "," + _TOP10_SQL, "day_")


def _renamed(sql: str, prefix: str) -> str:
    for name in ("trails", "owners", "bought", "top10"):
        sql = sql.replace(f"{name} AS (", f"{prefix}{name} AS (")
        sql = sql.replace(f"FROM {name}", f"FROM {prefix}{name}")
        sql = sql.replace(f"JOIN {name}", f"JOIN {prefix}{name}")
    return sql


def _rule_sql(rows: str, spec: schemas.TableSpec) -> list[str]:
    tests = [("not_null", c, f"{c} IS NULL") for c in spec.required]
    tests += [("max_length", c, f"length({c}) > {n}") for c, n in spec.lengths]
    selects = [
        f"SELECT '{spec.name}' AS table_name, '{rule}' AS rule, '{column}' AS column_name, "
        f"count(*) AS violations FROM {rows} WHERE {test}"
        for rule, column, test in tests
    ]
    if spec.key:
        keys = ", ".join(spec.key)
        selects.append(
            f"SELECT '{spec.name}', 'unique', '{keys}', count(*) FROM "
            f"(SELECT {keys} FROM {rows} GROUP BY {keys} HAVING count(*) > 1) k"
        )
    return selects


def _violations_sql() -> str:
    selects = []
    for spec in schemas.RAW:
        selects += _rule_sql(spec.name, spec)
    selects += _rule_sql("bought", schemas.CORE_BUY_PRODUCT)
    selects += _rule_sql("top10", schemas.DM_TOP10_PAGE)
    single = "(SELECT event_timestamp, 1 AS count_buy_product FROM bought) s"
    selects += _rule_sql(single, schemas.DM_BUY_PRODUCT)
    return " UNION ALL ".join(selects)


def _with(*parts: str, select: str) -> str:
    head = ",\n".join([fixtures.duckdb_ctes(), _RAW_SQL, *parts])
    return f"WITH {head}\n{select}"


ORACLES: dict[str, str] = {
    "land_browser": _with(select="SELECT * FROM stg_browser"),
    "land_device": _with(select="SELECT * FROM stg_device"),
    "land_geo": _with(select="SELECT * FROM stg_geo"),
    "land_location": _with(select="SELECT * FROM stg_location"),
    "hours_ready": _with(
        _READY_SQL,
        select="""
SELECT *, browser_events > 0 AND device_events > 0 AND geo_events > 0 AND location_events > 0
          AS ready
FROM (SELECT h.load_hour,
             count(CASE WHEN feed = 'b' THEN 1 END) AS browser_events,
             count(CASE WHEN feed = 'd' THEN 1 END) AS device_events,
             count(CASE WHEN feed = 'g' THEN 1 END) AS geo_events,
             count(CASE WHEN feed = 'l' THEN 1 END) AS location_events
      FROM hours h LEFT JOIN loads l ON l.load_hour = h.load_hour GROUP BY h.load_hour) c""",
    ),
    "raw_browser_events": _with(select="SELECT * FROM raw_browser_events"),
    "raw_device_events": _with(select="SELECT * FROM raw_device_events"),
    "raw_geo_events": _with(select="SELECT * FROM raw_geo_events"),
    "raw_location_events": _with(select="SELECT * FROM raw_location_events"),
    "core_buy_product": _with(_buy_sql("hour"), select="SELECT * FROM bought"),
    "core_buy_product_day": _with(_buy_sql("day"), select="SELECT * FROM bought"),
    "core_buy_product_split": _with(_buy_sql("day"), select="SELECT * FROM bought"),
    "funnel_steps": _with(_funnel_sql("hour"), select="SELECT * FROM stepped"),
    "funnel_steps_day": _with(_funnel_sql("day"), select="SELECT * FROM stepped"),
    "funnel_steps_split": _with(_funnel_sql("day"), select="SELECT * FROM stepped"),
    "core_payment_confirm": _with(_funnel_sql("hour"), select="SELECT * FROM paid"),
    "core_payment_confirm_split": _with(_funnel_sql("day"), select="SELECT * FROM paid"),
    "dm_buy_product": _with(_buy_sql("hour"), _COUNTED_SQL, select="SELECT * FROM counted"),
    "dm_top10_page": _with(_buy_sql("hour"), _TOP10_SQL, select="SELECT * FROM top10"),
    "dm_top10_page_day": _with(_buy_sql("day"), _TOP10_SQL, select="SELECT * FROM top10"),
    "dm_hourly_events": _with(
        select="""
SELECT date_trunc('hour', cast(event_timestamp AS timestamp)) AS event_hour,
       count(*) AS event_count
FROM stg_browser GROUP BY 1"""
    ),
    "dm_dist_events": _with(
        _buy_sql("hour"),
        _COUNTED_SQL,
        _funnel_sql("hour"),
        select="""
SELECT c.event_timestamp, c.count_buy_product AS count_cart, p.count_payment,
       p.count_confirmation
FROM counted c LEFT JOIN paid p ON p.event_timestamp = c.event_timestamp""",
    ),
    "backfill_dist_events": _with(
        _buy_sql("hour"),
        _COUNTED_SQL,
        _funnel_sql("hour"),
        select=f"""
SELECT c.event_timestamp, c.count_buy_product AS count_cart, p.count_payment,
       p.count_confirmation
FROM counted c LEFT JOIN paid p ON p.event_timestamp = c.event_timestamp
WHERE c.event_timestamp >= TIMESTAMP '{_REPLACED["start"]}'
  AND c.event_timestamp < TIMESTAMP '{_REPLACED["end"]}'""",
    ),
    "replace_hours_result": _with(
        _buy_sql("hour"),
        select=f"""
SELECT click_id, user_custom_id,
       CASE WHEN event_hour >= TIMESTAMP '{_REPLACED["start"]}'
             AND event_hour < TIMESTAMP '{_REPLACED["end"]}'
            THEN page_url_path ELSE concat('old:', page_url_path) END AS page_url_path,
       event_timestamp, event_hour
FROM bought""",
    ),
    "upsert_mart": _with(
        _buy_sql("hour"),
        _COUNTED_SQL,
        select="""
SELECT event_timestamp, coalesce(c.count_buy_product, d.n) AS count_buy_product
FROM (SELECT data_partition_ts AS event_timestamp, count(*) AS n
      FROM stg_device GROUP BY data_partition_ts) d
FULL JOIN counted c USING (event_timestamp)""",
    ),
    "upsert_top10": _with(
        _buy_sql("hour"),
        _TOP10_SQL,
        _day_top10(),
        select="""
SELECT event_timestamp, page_url_path,
       coalesce(h.count_page_url_path, d.count_page_url_path) AS count_page_url_path
FROM day_top10 d FULL JOIN top10 h USING (event_timestamp, page_url_path)""",
    ),
    "contract_violations": _with(_buy_sql("hour"), _TOP10_SQL, select=_violations_sql()),
}
# A backfill over every hour gives the whole mart.
ORACLES["backfill_dist_events_whole"] = ORACLES["dm_dist_events"]
