"""Calendar functions, as columns and as SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def week_start(moment: Column | str) -> Column:
    """The Sunday on or before a date or timestamp, as a DATE (``date_trunc('week')`` would give the Monday)."""
    column = F.col(moment) if isinstance(moment, str) else moment
    return F.date_sub(F.to_date(column), F.dayofweek(column) - 1)


def register_functions(spark: SparkSession) -> None:
    """Make ``week_start(timestamp)`` usable in SQL text. It is a SQL function, so Catalyst inlines it."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION week_start(moment TIMESTAMP_NTZ) RETURNS DATE "
        "RETURN date_sub(to_date(moment), dayofweek(moment) - 1)"
    )
