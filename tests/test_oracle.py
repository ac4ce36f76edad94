"""Every registered query against SQL run by an independent engine on the same files."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest
from helpers import DATA

import __spark_entry__ as driver

SF_DIR = os.environ.get("TEST_SF_DIR", f"{DATA}/sf0.001")
QUERIES, SQL = driver.shop_queries(), driver.shop_sql()


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, engine, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    answer = engine.execute(SQL[name])
    names = [column[0] for column in answer.description]
    assert sorted(names) == columns
    order = [names.index(column) for column in columns]
    expected = Counter(tuple(row[i] for i in order) for row in answer.fetchall())
    assert Counter(tuple(row) for row in result.select(*columns).collect()) == expected


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_entry_gives_the_flagship_ranking(spark):
    totals = [row.Total_Rental for row in driver.entry(spark).collect()]
    assert totals == sorted(totals, reverse=True) and totals


@pytest.mark.parametrize("name", ["top_actor", "top_film", "top_customer_from_stage"])
def test_rankings_come_out_sorted(spark, name):
    rows = [(-row.Total_Rental, row[0]) for row in QUERIES[name](spark, SF_DIR).collect()]
    assert rows == sorted(rows)
