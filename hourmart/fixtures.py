"""Staging views derived from the driver's ``events`` table.

One SQL text serves both engines; four expressions differ and are filled in.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmart.schemas import FEEDS, LOAD_HOUR

_DIALECTS = {
    "duckdb": {
        "HOUR": "date_trunc('hour', ts)",
        "DAY": "date_trunc('day', ts)",
        "TXT": "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')",
    },
    "spark": {
        "HOUR": "cast(date_trunc('hour', ts) AS timestamp_ntz)",
        "DAY": "cast(date_trunc('day', ts) AS timestamp_ntz)",
        "TXT": "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')",
    },
}

_BASE = """
SELECT cast(event_id AS string) AS event_id, event_id AS n, ts, event_type, user_id,
       {HOUR} AS hour_ts, {DAY} AS day_ts, {TXT} AS ts_text,
       concat('c', cast(user_id % 20 AS string)) AS click_id,
       concat('u', cast(user_id % 10 AS string)) AS user_custom_id,
       CASE event_type
         WHEN 'view' THEN concat('/product_', cast(event_id % 25 AS string))
         WHEN 'click' THEN '/cart'
         WHEN 'purchase' THEN '/payment'
         WHEN 'signup' THEN '/confirmation'
         ELSE '/home' END AS page
FROM events
"""

_BROWSER_ROWS = """
SELECT event_id, click_id, {text} AS event_timestamp, event_type,
       CASE WHEN n % 3 = 0 THEN 'Firefox' ELSE 'Chrome' END AS browser_name,
       CASE WHEN n % 2 = 0 THEN 'en' ELSE 'ru' END AS browser_language,
       concat('UA/', cast(n % 7 AS string)) AS browser_user_agent,
       hour_ts AS data_partition_ts
FROM fx_base {condition}
"""

_LOCATION_ROWS = """
SELECT event_id, concat('https://shop.example.com', page) AS page_url, page AS page_url_path,
       cast(NULL AS string) AS referer_url, 'internal' AS referer_medium,
       cast(NULL AS string) AS utm_medium, cast(NULL AS string) AS utm_source,
       cast(NULL AS string) AS utm_content, cast(NULL AS string) AS utm_campaign,
       hour_ts AS data_partition_ts
FROM fx_base {condition}
"""

_GEO_ROWS = """
SELECT DISTINCT click_id, CASE WHEN user_id % 20 < 7 THEN 'RU' ELSE 'KZ' END AS geo_country,
       cast(NULL AS string) AS geo_timezone, cast(NULL AS string) AS geo_region_name,
       cast(NULL AS string) AS ip_address,
       cast((user_id % 20) * 1.5 AS double) AS geo_latitude,
       cast((user_id % 20) * -2.0 AS double) AS geo_longitude,
       day_ts AS data_partition_ts
FROM fx_base {condition}
"""

_VIEWS = {
    "browser_events": " UNION ALL ".join(
        [
            _BROWSER_ROWS.format(text="ts_text", condition=""),
            _BROWSER_ROWS.format(text="ts_text", condition="WHERE n % 10 = 0"),
            _BROWSER_ROWS.format(
                text="replace(ts_text, ' ', 'T')", condition="WHERE n % 50 = 0"
            ),
        ]
    ),
    "device_events": """
SELECT DISTINCT click_id,
       CASE WHEN user_id % 2 = 0 THEN 'Desktop' ELSE 'Mobile' END AS device_type,
       user_id % 2 = 1 AS device_is_mobile, user_custom_id, 'shop' AS user_domain_id,
       cast(NULL AS string) AS os, 'Linux' AS os_name, 'UTC' AS os_timezone,
       day_ts AS data_partition_ts
FROM fx_base WHERE click_id <> 'c19'
""",
    "geo_events": " UNION ALL ".join(
        [
            _GEO_ROWS.format(condition=""),
            _GEO_ROWS.format(condition="WHERE click_id = 'c3'"),
        ]
    ),
    "location_events": " UNION ALL ".join(
        [
            _LOCATION_ROWS.format(condition=""),
            _LOCATION_ROWS.format(condition="WHERE n % 10 = 1"),
        ]
    ),
}


def staging_view_name(feed: str) -> str:
    return f"stg_{feed.removesuffix('_events')}"


def duckdb_ctes() -> str:
    """``fx_base`` and the four staging views as the head of a WITH clause."""
    parts = [f"fx_base AS ({_BASE.format(**_DIALECTS['duckdb'])})"]
    parts += [f"{staging_view_name(feed)} AS ({_VIEWS[feed]})" for feed in FEEDS]
    return ",\n".join(parts)


class _Staging(Mapping):
    """The feeds as frames; each is planned when it is first asked for."""

    def __init__(self, base: DataFrame) -> None:
        self._base, self._frames = base, {}

    def __getitem__(self, feed: str) -> DataFrame:
        if feed not in self._frames:
            view = _VIEWS[feed].replace("FROM fx_base", "FROM {b}")
            self._frames[feed] = self._base.sparkSession.sql(view, b=self._base)
        return self._frames[feed]

    def __iter__(self) -> Iterator[str]:
        return iter(FEEDS)

    def __len__(self) -> int:
        return len(FEEDS)


def staging_frames(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """The four staging feeds derived from ``events``."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    base = spark.sql(_BASE.format(**_DIALECTS["spark"]).replace("FROM events", "FROM {e}"), e=events)
    return _Staging(base)


def zipped_objects(rows: DataFrame, feed: str) -> DataFrame:
    """Staging rows packed the way a bucket holds them: zipped JSON lines, each
    object of one load hour (an hour may come in several objects)."""
    member = f"{feed}.jsonl"
    kinds = pa.schema(
        [(LOAD_HOUR, pa.timestamp("us")), ("path", pa.string()), ("content", pa.binary())]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_hour: dict = {}
            for hour, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_hour.setdefault(hour, []).append(line)
            packed = []
            for lines in by_hour.values():
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr(member, "\n".join(lines))
                packed.append(buffer.getvalue())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(by_hour), pa.timestamp("us")),
                    pa.array([f"{member}.zip"] * len(packed), pa.string()),
                    pa.array(packed, pa.binary()),
                ],
                schema=kinds,
            )

    fields = [name for name in rows.columns if name != LOAD_HOUR]
    lines = rows.select(LOAD_HOUR, F.to_json(F.struct(*fields)).alias("line"))
    return lines.mapInArrow(pack, f"{LOAD_HOUR} TIMESTAMP_NTZ, path STRING, content BINARY")
