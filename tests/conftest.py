from __future__ import annotations

import sys
import uuid
from datetime import datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from hourmart.session import build_session  # noqa: E402

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__sql__debug__maxToStringFields="1000",
        spark__sql__maxMetadataStringLength="10000",
        spark__driver__memory="4g",
        spark__driver__host="localhost",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def database(spark):
    name = f"d{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def at(text: str) -> datetime:
    """``"10:59:59.6"`` on the first of January 2024."""
    return datetime.fromisoformat(f"2024-01-01 {text}")


def rows_of(frame) -> list[tuple]:
    """Rows as sorted text tuples, columns by name."""
    names = sorted(frame.columns)
    found = frame.select(*names).collect()
    return sorted(tuple("NULL" if v is None else str(v) for v in row) for row in found)
