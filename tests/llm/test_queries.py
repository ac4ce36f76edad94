"""Registered queries against SQL."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as driver
from rentmill.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.SQL)
def test_query_matches_sql(spark, name):
    engine = duckdb.connect()
    for file in os.listdir(FOLDER):
        engine.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    result = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(result.columns)
    answer = engine.execute(f"SELECT {', '.join(columns)} FROM ({queries.SQL[name]}) AS q")
    assert Counter(tuple(r) for r in result.select(*columns).collect()) == Counter(answer.fetchall())


def test_all_are_registered():
    named = driver.queries()
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert "pipeline" in named and set(queries.QUERIES) < set(named)
