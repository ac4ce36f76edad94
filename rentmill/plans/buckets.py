"""Staging from fact tables that are stored in buckets of the key they are joined on.

Rentals are stored by copy and payments by customer, so the join of a stage reads each bucket in one task and the facts are not
shuffled at all; only the dimensions, joined to each other first, move to the buckets. Link tables are stored by film,
so joining copies to films moves the copies alone.

A bucket is one task's work, whatever it holds: adaptive execution cannot split a join side that is not shuffled. So the number of
buckets grows with the rows (:func:`bucket_number`). Keep to the plain layout (:func:`rentmill.plans.layers.build_staging` without buckets)
where one key owns a large share of all facts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from rentmill.parallel import for_each
from rentmill.plans.staging import STAGES
from rentmill.schemas import ACCESS, SCHEMAS, STAGING, TABLES
from rentmill.sinks.layers import write_layer
from rentmill.sources.layers import count_layer, load_layer, read_bucketed, read_layer

# Table -> the key its rows are stored by.
BUCKETED = {"rental": "inventory_id", "payment": "customer_id", "film_actor": "film_id", "film_category": "film_id"}
LINKED = ("Top_Actor", "Top_Category")
# Rows that meet the facts of one bucket, or are in it, at most on average: a task sorts them in a few hundred MB.
BUCKET_ROWS = 2_000_000


def bucketed_of(table: str) -> str:
    """The access table with the rows of ``table`` in buckets."""
    return f"{table}_bucketed"


def bucket_number(spark: SparkSession, root: str, least: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """``least``, doubled until no stage has more than about ``bucket_rows`` rows per bucket.

    Counted are the tables as they were written, and the links repeated for every copy of their film (:func:`stage_in_buckets`),
    whose number follows from the mean of links per film.
    """
    names = (*BUCKETED, "inventory", "film")
    rows = dict(zip(names, for_each(spark, names, lambda table: count_layer(spark, root, ACCESS, table))))
    repeated = [rows["inventory"] * rows[links] // max(rows["film"], 1) for links in ("film_actor", "film_category")]
    number = least
    while number * bucket_rows < max(*repeated, *(rows[table] for table in BUCKETED)):
        number *= 2
    return number


def store_buckets(spark: SparkSession, root: str, number: int, bucket_rows: int = BUCKET_ROWS) -> None:
    """Write the bucketed form of the fact and link tables of the access layer, in ``number`` buckets or more (:func:`bucket_number`)."""
    number = bucket_number(spark, root, number, bucket_rows)

    def store(table: str) -> None:
        rows = read_layer(spark, root, ACCESS, table, SCHEMAS[table])
        write_layer(rows, root, ACCESS, bucketed_of(table), bucket_by=(BUCKETED[table], number))

    for_each(spark, BUCKETED, store)


def bucketed_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The access tables, those of :data:`BUCKETED` from their buckets."""
    plain = load_layer(spark, root, ACCESS, [table for table in TABLES if table not in BUCKETED], SCHEMAS)
    return plain | {table: read_bucketed(spark, root, ACCESS, bucketed_of(table)) for table in BUCKETED}


def stage_in_buckets(target: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """A staging table whose facts are read in buckets: dimensions are joined to each other and then to the facts."""
    order = {"copies_first": True} if target in LINKED else {}
    return STAGES[target](tables, broadcast_limit=-1, **order)


def build_staging_in_buckets(spark: SparkSession, root: str, number: int) -> None:
    """Write the six staging tables by way of ``number`` buckets or more."""
    store_buckets(spark, root, number)
    tables = bucketed_tables(spark, root)
    for_each(spark, STAGES, lambda target: write_layer(stage_in_buckets(target, tables), root, STAGING, target))
