"""Business tables: how often each actor, category, customer, city, film and store was rented.

Groups are names, not ids: two actors of one name are one group.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentmill.operators.counting import COUNT, carry_counts, counted_rows, sum_counts
from rentmill.operators.ranking import TOTAL, order_by_total, rank_by_count
from rentmill.schemas import BRIDGES


@dataclass(frozen=True)
class Ranking:
    """A ranking as a grouping of its staging table, and as a route from the fact table."""

    key: str
    name: str
    fact: str
    fact_key: str
    hops: tuple[tuple[str, str], ...]


def _of_rentals(key: str, name: str, *hops: tuple[str, str]) -> Ranking:
    return Ranking(key, name, "rental", "inventory_id", hops)


def _of_payments(key: str, name: str, *hops: tuple[str, str]) -> Ranking:
    return Ranking(key, name, "payment", "customer_id", hops)


# The rankings' names, grouping columns and output names.
RANKINGS: dict[str, Ranking] = {
    "Top_Actor": _of_rentals(
        "last_name", "last_name", ("inventory", "film_id"), ("film_actor", "actor_id"), ("actor", "last_name")
    ),
    "Top_Category": _of_rentals(
        "name", "Category", ("inventory", "film_id"), ("film_category", "category_id"), ("category", "name")
    ),
    "Top_Customer": _of_payments("last_name", "Customer", ("customer", "last_name")),
    "Top_City": _of_payments("city", "city", ("customer", "address_id"), ("address", "city_id"), ("city", "city")),
    "Top_Film": _of_rentals("title", "title", ("inventory", "film_id"), ("film", "title")),
    "Top_Store": _of_rentals("store_id", "store_id", ("inventory", "store_id"), ("store", "store_id")),
}


def rank(target: str, stage: DataFrame, limit: int | None = None, tie_break: bool = True) -> DataFrame:
    """The ranking ``target`` from its staging table."""
    ranking = RANKINGS[target]
    return rank_by_count(stage, ranking.key, ranking.name, limit, tie_break)


def count_facts(ranking: Ranking, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rentals (or payments) per key of the fact table, where the ranking's route starts."""
    return sum_counts(_facts(ranking, tables), ranking.fact_key)


def _facts(ranking: Ranking, tables: Mapping[str, DataFrame]) -> DataFrame:
    return counted_rows(tables[ranking.fact], ranking.fact_key)


def rank_directly(
    target: str,
    tables: Mapping[str, DataFrame],
    counts: DataFrame | None = None,
    limit: int | None = None,
    tie_break: bool = True,
    **join_settings: int,
) -> DataFrame:
    """The same ranking from the access tables, without building staging rows.

    ``counts`` takes the result of :func:`count_facts` where a caller has stored it.
    """
    ranking = RANKINGS[target]
    counts = _facts(ranking, tables) if counts is None else counts
    counts = carry_counts(counts, ranking.fact_key, tables, ranking.hops, BRIDGES, **join_settings)
    totals = counts.select(F.col(ranking.key).alias(ranking.name), F.col(COUNT).alias(TOTAL))
    return order_by_total(totals, ranking.name, limit, tie_break)
