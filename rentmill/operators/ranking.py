"""Rankings and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOTAL = "Total_Rental"


def order_by_total(df: DataFrame, key: str, limit: int | None = None, tie_break: bool = True) -> DataFrame:
    """Largest total first.

    The key decides among equal totals. That makes the order repeatable, and it keeps the sort's ranges
    even when most groups share one total, which would otherwise all land in a single task.
    """
    ordered = df.orderBy(F.desc(TOTAL), F.asc(key)) if tie_break else df.orderBy(F.desc(TOTAL))
    return ordered if limit is None else ordered.limit(limit)


def rank_by_count(
    df: DataFrame,
    key: str,
    alias: str | None = None,
    limit: int | None = None,
    tie_break: bool = True,
    counted: str = "rental_id",
) -> DataFrame:
    """Rows with a non-null ``counted`` per value of ``key``; null is a group, and a group may count zero."""
    name = alias or key
    totals = df.groupBy(F.col(key).alias(name)).agg(F.count(counted).alias(TOTAL))
    return order_by_total(totals, name, limit, tie_break)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows, for looking at."""
    return df.limit(n)
