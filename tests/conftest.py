from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rentmill.schemas import SCHEMAS
from rentmill.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        initial_partitions=4,
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("scratch")),
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def setting(spark):
    """Change session settings for one test."""
    before = {}

    def change(**settings: object) -> None:
        for name, value in settings.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, str(value))

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def shop(spark):
    """Build rental tables from short rows; columns that are not named stay null, tables not named are empty."""

    def build(**tables: tuple[str, list[tuple]]) -> dict:
        frames = {}
        for table, schema in SCHEMAS.items():
            columns, rows = tables.get(table, ("", []))
            named = columns.split()
            full = [tuple(dict(zip(named, row)).get(name) for name in schema.fieldNames()) for row in rows]
            frames[table] = spark.createDataFrame(full, schema)
        return frames

    return build
