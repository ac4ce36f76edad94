"""Hand-made cases for staging rows and rankings, with the answers worked out by hand or by brute force."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from helpers import bag

from rentmill.operators.ranking import preview, rank_by_count
from rentmill.plans.business import RANKINGS, rank, rank_directly
from rentmill.plans.staging import STAGES

SALTED = dict(plain_join_bytes=0, hot_links=2)


def both_ways(target, tables, **settings) -> Counter:
    """A ranking from its staging rows; the direct form must agree, plain and salted."""
    expected = bag(rank(target, STAGES[target](tables)))
    assert bag(rank_directly(target, tables, plain_join_bytes=1 << 80)) == expected
    assert bag(rank_directly(target, tables, **SALTED)) == expected
    return expected


def test_null_and_dangling_keys_drop_out(shop):
    tables = shop(
        rental=("rental_id inventory_id customer_id", [(1, 10, 5), (2, None, 5), (3, 99, 5), (4, 11, 5)]),
        inventory=("inventory_id film_id store_id", [(10, 1, 1), (11, 1, 9), (12, None, 1)]),
        film=("film_id title release_year rating", [(1, "Up", 2001, "G"), (None, "Nil", 2002, "G")]),
        store=("store_id", [(1,)]),
    )
    assert bag(STAGES["Top_Film"](tables)) == {("Up", 2001, "G", 1): 1, ("Up", 2001, "G", 4): 1}
    assert bag(STAGES["Top_Store"](tables)) == {(1, 1): 1}
    assert both_ways("Top_Film", tables) == {("Up", 2): 1}
    assert both_ways("Top_Store", tables) == {(1, 1): 1}


def test_same_names_merge_and_bridge_rows_multiply(shop):
    tables = shop(
        rental=("rental_id inventory_id customer_id", [(1, 10, 5), (2, 10, 6), (3, 11, 5)]),
        inventory=("inventory_id film_id store_id", [(10, 1, 1), (11, 2, 1)]),
        film_actor=("film_id actor_id", [(1, 1), (1, 1), (1, 2), (2, 3), (2, None)]),
        actor=("actor_id last_name", [(1, "WOOD"), (2, "WOOD"), (3, None)]),
    )
    assert bag(STAGES["Top_Actor"](tables)) == {
        ("WOOD", 1, 5): 3, ("WOOD", 2, 6): 3, (None, 3, 5): 1,
    }
    assert both_ways("Top_Actor", tables) == {("WOOD", 6): 1, (None, 1): 1}


def test_a_film_counts_in_each_of_its_categories(shop):
    tables = shop(
        rental=("rental_id inventory_id", [(1, 10), (1, 10)]),
        inventory=("inventory_id film_id", [(10, 1)]),
        film_category=("film_id category_id", [(1, 7), (1, 8)]),
        category=("category_id name", [(7, "Drama"), (8, "Music")]),
    )
    assert both_ways("Top_Category", tables) == {("Drama", 2): 1, ("Music", 2): 1}


def test_payments_are_counted_only_with_a_rental(shop):
    tables = shop(
        payment=("customer_id rental_id amount", [(1, 100, None), (1, None, None), (2, None, None), (3, 7, None)]),
        customer=("customer_id store_id last_name address_id", [(1, 4, "A", 1), (2, 4, "B", 2)]),
        address=("address_id city_id", [(1, 1), (2, 1)]),
        city=("city_id city", [(1, "Lima")]),
    )
    assert bag(STAGES["Top_Customer"](tables)) == {
        ("A", 4, 100, None): 1, ("A", 4, None, None): 1, ("B", 4, None, None): 1,
    }
    assert both_ways("Top_Customer", tables) == {("A", 1): 1, ("B", 0): 1}
    assert both_ways("Top_City", tables) == {("Lima", 1): 1}


@pytest.mark.parametrize("target", RANKINGS)
def test_empty_tables_give_empty_results_of_the_same_schema(shop, target):
    tables = shop()
    staged, direct = rank(target, STAGES[target](tables)), rank_directly(target, tables, **SALTED)
    assert both_ways(target, tables) == {}
    assert staged.dtypes == direct.dtypes
    assert staged.columns == [RANKINGS[target].name, "Total_Rental"]


def test_a_hot_film_matches_brute_force(shop):
    """One film owns a third of all rentals and of all cast rows; some keys are null or dangling."""
    rng = random.Random(7)
    films, actors = 40, 60

    def film():
        return 1 if rng.random() < 1 / 3 else rng.choice([None, *range(2, films + 3)])

    inventory = [(i, film(), rng.randrange(4)) for i in range(120)]
    rental = [(rng.choice([None, n]), rng.choice([None, 0, rng.randrange(130)]), n % 9) for n in range(3000)]
    cast = [(film(), rng.randrange(actors + 2)) for _ in range(900)]
    actor = [(a, f"N{a % 13}") for a in range(actors)]
    tables = shop(
        rental=("rental_id inventory_id customer_id", rental),
        inventory=("inventory_id film_id store_id", inventory),
        film_actor=("film_id actor_id", cast),
        actor=("actor_id last_name", actor),
        film=("film_id title", [(f, f"T{f % 7}") for f in range(films)]),
        store=("store_id", [(0,), (1,), (2,), (2,)]),
    )
    film_of, store_of = {i: f for i, f, _ in inventory}, {i: s for i, _, s in inventory}
    names, played_by = dict(actor), defaultdict(list)
    for f, a in cast:
        if a in names:
            played_by[f].append(names[a])
    by_actor, by_film, by_store = Counter(), Counter(), Counter()
    for rental_id, copy, _ in rental:
        counts = rental_id is not None
        f = film_of.get(copy)
        if f is not None:
            for name in played_by[f]:
                by_actor[name] += counts
            if f < films:
                by_film[f"T{f % 7}"] += counts
        if store_of.get(copy) in (0, 1, 2):
            by_store[store_of[copy]] += counts * (2 if store_of[copy] == 2 else 1)

    assert both_ways("Top_Actor", tables) == Counter(by_actor.items())
    assert both_ways("Top_Film", tables) == Counter(by_film.items())
    assert both_ways("Top_Store", tables) == Counter(by_store.items())


def test_totals_add_up_to_the_counted_rows(shop):
    rows = [(n, n % 3 or None, None) for n in range(50)]
    tables = shop(
        payment=("rental_id customer_id amount", rows),
        customer=("customer_id last_name", [(1, "A"), (2, "B")]),
    )
    stage = STAGES["Top_Customer"](tables)
    total = sum(row.Total_Rental for row in rank("Top_Customer", stage).collect())
    assert total == stage.where("rental_id IS NOT NULL").count()


def test_ties_break_by_key_and_limit_takes_the_top(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 1), ("c", 2), ("d", None)], "name string, rental_id long")
    ranked = rank_by_count(df, "name", "Category")
    assert [tuple(row) for row in ranked.collect()] == [("c", 2), ("a", 1), ("b", 1), ("d", 0)]
    top = rank_by_count(df, "name", limit=2)
    assert [tuple(row) for row in top.collect()] == [("c", 2), ("a", 1)]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    untied = rank_by_count(df, "name", tie_break=False).collect()
    assert [row.Total_Rental for row in untied] == [2, 1, 1, 0]


def test_preview(spark):
    ordered = spark.range(100).orderBy("id")
    assert [row.id for row in preview(ordered, 2).collect()] == [0, 1]
    assert preview(ordered).count() == 20
