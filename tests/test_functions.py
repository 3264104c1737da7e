from __future__ import annotations

from datetime import datetime, timezone

import pytest
from conftest import at
from pyspark.sql import functions as F

from hourmart import functions as fn


def one(spark, expression, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values))
    return row.select(expression.alias("x")).first()["x"]


def ntz(spark, text, expression):
    row = spark.sql(f"SELECT TIMESTAMP_NTZ'{text}' AS ts")
    return row.select(expression.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, rounded",
    [
        ("2024-01-01 10:59:59.600", "2024-01-01 11:00:00"),
        ("2024-01-01 10:59:59.500", "2024-01-01 11:00:00"),
        ("2024-01-01 10:59:59.499999", "2024-01-01 10:59:59"),
        ("1999-12-31 23:59:58.500", "1999-12-31 23:59:58"),
        ("1999-12-31 23:59:58.500001", "1999-12-31 23:59:59"),
    ],
)
def test_round_to_second(spark, text, rounded):
    got = ntz(spark, text, fn.round_to_second(F.col("ts")))
    assert got == datetime.fromisoformat(rounded)


def test_bucket_grains(spark):
    assert ntz(spark, "2024-01-01 10:59:59.6", fn.bucket("ts")) == at("10:00")
    assert ntz(spark, "2024-01-01 10:59:59.6", fn.bucket("ts", "day")) == at("00:00")
    assert ntz(spark, "1969-12-31 22:30:00.5", fn.bucket("ts")) == datetime(1969, 12, 31, 22)
    assert ntz(spark, "1969-12-31 22:30:00.5", fn.bucket("ts", "day")) == datetime(1969, 12, 31)
    with pytest.raises(ValueError):
        fn.bucket("ts", "week")


def test_bucket_ignores_the_session_zone(spark):
    """Half past two did not exist in New York on this day."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = ntz(spark, "2024-03-10 02:30:00", fn.bucket("ts"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == datetime(2024, 3, 10, 2)


def test_as_hour():
    assert fn.as_hour("2024-01-01 10:00:00") == at("10:00")
    assert fn.as_hour(datetime(2024, 1, 1, 10, tzinfo=timezone.utc)) == at("10:00")
    assert fn.as_hour("2024-01-01T13:00:00+03:00") == at("10:00")
    with pytest.raises(ValueError):
        fn.as_hour("2024-01-01 10:30:00")


def test_parse_timestamp_ignores_the_zone_and_fails_on_bad_text(spark):
    assert one(spark, fn.parse_timestamp("t"), t="2024-01-01T10:00:00+03:00") == at("10:00")
    assert one(spark, fn.parse_timestamp("t"), t="2024-01-01 10:00:00.25") == at("10:00:00.25")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, fn.parse_timestamp("t"), t="yesterday")


def test_plain_timestamp_of_zoned_column(spark):
    row = spark.sql("SELECT TIMESTAMP'2024-01-01 13:00:00+03:00' AS ts")
    assert row.select(fn.plain_timestamp(row, "ts").alias("x")).first()["x"] == at("10:00")


@pytest.mark.parametrize(
    "page, like, prefix",
    [
        ("/product", False, True),
        ("/products", True, True),
        ("/product_1", True, True),
        ("xproduct", False, True),
        ("/cart", False, False),
    ],
)
def test_product_tests_differ(spark, page, like, prefix):
    assert one(spark, fn.is_product_like(F.col("p")), p=page) is like
    assert one(spark, fn.is_product_prefix(F.col("p")), p=page) is prefix


def test_range_is_half_open_and_drops_missing_times(spark):
    rows = spark.sql(
        "SELECT cast(col AS timestamp_ntz) ts FROM values ('2024-01-01 09:59:59.9'),"
        "('2024-01-01 10:00:00'),('2024-01-01 10:59:59.9'),('2024-01-01 11:00:00'),(NULL) t(col)"
    )
    found = fn.in_range(rows, "ts", "2024-01-01 10:00:00", "2024-01-01 11:00:00").collect()
    assert [row.ts for row in found] == [at("10:00"), at("10:59:59.9")]
    assert fn.in_range(rows, "ts", None, None).count() == 4
