"""Times the headline queries and a whole catch-up run; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from datetime import datetime
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from hourmart import fixtures, schemas  # noqa: E402
from hourmart.catalog import QUERIES  # noqa: E402
from hourmart.plans.backfill import backfill  # noqa: E402
from hourmart.session import build_session  # noqa: E402
from hourmart.sources.tables import overwrite_partitions  # noqa: E402

HEADLINE = (
    "raw_browser_events",
    "raw_device_events",
    "raw_geo_events",
    "raw_location_events",
    "core_buy_product",
    "funnel_steps",
    "core_payment_confirm",
    "dm_buy_product",
    "dm_top10_page",
    "dm_hourly_events",
    "dm_dist_events",
    "hours_ready",
    "land_browser",
    "replace_hours_result",
    "upsert_top10",
)
MONTH = (datetime(2024, 1, 1), datetime(2024, 2, 1))
RUNS = 2


def run(frame) -> None:
    """Every row is computed, none is sent to the driver."""
    frame.write.format("noop").mode("overwrite").save()


def best(work) -> float:
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        work()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__driver__host="localhost",
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="hourmart-bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {name: best(lambda q=QUERIES[name]: run(q(spark, sf_dir))) for name in HEADLINE}

    spark.sql("CREATE DATABASE bench")
    rows = 0
    for feed, frame in fixtures.staging_frames(spark, sf_dir).items():
        if feed == "device_events":
            # The one click without a device would stop the write, as it must.
            known = {"click_id": F.lit("c19"), "user_custom_id": F.lit("u9")}
            frame = frame.unionByName(frame.limit(1).withColumns(known))
        overwrite_partitions(spark, frame, schemas.STAGING[feed], "bench")
        rows += frame.count()
    start = time.perf_counter()
    backfill(spark, *MONTH, database="bench")
    caught_up = time.perf_counter() - start

    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "staged_rows": rows,
                "backfill_month_sec": round(caught_up, 3),
                "backfill_rows_per_sec": round(rows / caught_up),
                "backfill_hours_per_sec": round(744 / caught_up, 1),
                "runs": RUNS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
