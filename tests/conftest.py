from __future__ import annotations

from datetime import datetime, timezone

import pytest

from layerkit.session import local_session, scratch_dir, scratch_schema


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def schema(spark):
    return scratch_schema(spark, "test")


@pytest.fixture
def folder(spark):
    return scratch_dir(spark, "test")


def at(day: int, hour: int = 0) -> datetime:
    return datetime(2024, 1, day, hour, tzinfo=timezone.utc)


EDGE_DDL = "id string, name string, type string, state string, lat string, day string, ts int"
EDGE_ROWS = [
    ("a", "o'fallon SAN-juan", "MICRO", "x", "45.0", "2024-01-01", 1),
    ("a", "new name", "micro", "x", "45.0", "2024-01-02", 1),
    ("a", "newest", "micro", "x", "45.0", "2024-01-02", 2),
    (None, "n1", None, None, "n/a", "2024-01-01", 1),
    (None, "n2", "bar", None, "NaN", "2024-01-02", 1),
    ("", "", "large", None, "", "2024-01-01", 1),
    ("b", None, "large", "y", "91", "2023-01-01", 1),
    ("c", "c", "large", "y", "45d", None, 1),
    ("d", "d", "large", "y", "0", "junk", 1),
]


@pytest.fixture
def edge(spark):
    return spark.createDataFrame(EDGE_ROWS, EDGE_DDL)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
