"""Database tables over JDBC, read in parallel ranges of a key."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from rentmill.schemas import SPLIT_KEYS

# Times without a zone stay without one, whatever the zone of the JVM. A caller's properties replace these.
DEFAULTS = {"fetchsize": 10_000, "preferTimestampNTZ": True}

# The largest key of each of a number of equal groups of rows, in standard SQL.
QUANTILES = (
    "SELECT MAX(split_key) AS bound FROM (SELECT {key} AS split_key, NTILE({partitions}) OVER (ORDER BY {key}) AS tile "
    "FROM {table} WHERE {key} IS NOT NULL) AS keys GROUP BY tile ORDER BY bound"
)


def range_predicates(key: str, quantiles: Sequence[object]) -> list[str]:
    """Conditions that every row meets exactly one of, cut at the inner quantiles; null keys are in the first. None without a cut."""
    cuts = [_literal(cut) for cut in sorted(set(quantiles))[:-1]]
    if not cuts:
        return []
    inner = [f"{key} > {low} AND {key} <= {high}" for low, high in zip(cuts, cuts[1:])]
    return [f"{key} <= {cuts[0]} OR {key} IS NULL", *inner, f"{key} > {cuts[-1]}"]


def _literal(value: object) -> str:
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    raise ValueError(f"cannot split on a key of {type(value).__name__}")


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    key: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    by_quantiles: bool = False,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Every row and column of ``table``.

    With a numeric or date ``key`` and more than one partition, each task reads one range of the key; rows
    outside ``bounds`` or with a null key still arrive, in the outer ranges. Missing bounds are asked of
    the database in a query that returns one row.

    Ranges are equally wide, so a key with gaps or crowded stretches fills some tasks and leaves others idle.
    ``by_quantiles`` asks the database for the key's quantiles instead (a sort of the key there, a row per partition back) and gives every
    task about as many rows. A single key value is never split, so equal quantiles give fewer ranges.
    """
    options = DEFAULTS | {"url": url} | dict(properties or {})
    source = spark.read.format("jdbc").options(**options)
    if key is None or partitions <= 1:
        return source.option("dbtable", table).load()
    if by_quantiles:
        asked = source.option("query", QUANTILES.format(key=key, table=table, partitions=partitions)).load().collect()
        ranges = range_predicates(key, [row[0] for row in asked])
        if not ranges:
            return read_jdbc_table(spark, url, table, properties=properties)
        given = {name: str(value).lower() if isinstance(value, bool) else str(value) for name, value in options.items() if name != "url"}
        return spark.read.jdbc(url, table, predicates=ranges, properties=given)
    if bounds is None:
        lowest, highest = source.option("query", f"SELECT MIN({key}), MAX({key}) FROM {table}").load().first()
        if lowest is None:
            return read_jdbc_table(spark, url, table, properties=properties)
        bounds = (lowest, highest)
    return (
        spark.read.format("jdbc")
        .options(**options, dbtable=table)
        .options(partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions)
        .load()
    )


def jdbc_source(
    spark: SparkSession,
    url: str,
    *,
    partitions: int = 8,
    keys: Mapping[str, str] = SPLIT_KEYS,
    by_quantiles: bool = False,
    properties: Mapping[str, str] | None = None,
) -> Callable[[str], DataFrame]:
    """A source for :func:`rentmill.plans.pipeline.run_pipeline`: table name to DataFrame."""
    return lambda table: read_jdbc_table(
        spark, url, table, key=keys.get(table), partitions=partitions, by_quantiles=by_quantiles, properties=properties
    )
