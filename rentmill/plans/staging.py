"""Staging tables: facts joined to the dimension they will be ranked by, one row per joined match.

Every join is inner on one key. Rows with null or dangling keys drop out and duplicates multiply; nothing is
de-duplicated.

Both inputs of each join are plain shuffles (or broadcasts, when the planner finds a side small), so adaptive
execution can split a key that owns a large share of the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from rentmill.operators.joins import join_through

Tables = Mapping[str, DataFrame]

# Not a source table: rentals with the film and the store of their copy, shared by four stages.
RENTED_FILMS = "rented_films"


def rented_films(t: Tables) -> DataFrame:
    rental = t["rental"].select("inventory_id", "rental_id", "customer_id")
    return rental.join(t["inventory"].select("inventory_id", "film_id", "store_id"), "inventory_id").drop("inventory_id")


def _rented_films(t: Tables) -> DataFrame:
    """The stored join if a caller supplies it, else the join itself."""
    return t[RENTED_FILMS] if RENTED_FILMS in t else rented_films(t)


def _by_film(t: Tables, links: DataFrame, names: tuple[DataFrame, str], broadcast_limit: int | None, copies_first: bool) -> DataFrame:
    """Rentals joined to what their films are linked to."""
    if copies_first:
        rental = t["rental"].select("inventory_id", "rental_id", "customer_id")
        copies = t["inventory"].select("inventory_id", "film_id")
        return join_through(rental, (copies, "inventory_id"), (links, "film_id"), names, broadcast_limit=broadcast_limit)
    rented = _rented_films(t).select("film_id", "rental_id", "customer_id")
    return join_through(rented, (links, "film_id"), names, broadcast_limit=broadcast_limit)


def stage_actor(t: Tables, broadcast_limit: int | None = None, copies_first: bool = False) -> DataFrame:
    """A rental appears once for every actor of its film.

    With ``copies_first`` the links are joined to the copies before the rentals, which then move once or, stored by copy, not at all;
    the links are repeated for every copy of their film.
    """
    cast = t["film_actor"].select("film_id", "actor_id")
    joined = _by_film(t, cast, (t["actor"].select("actor_id", "last_name"), "actor_id"), broadcast_limit, copies_first)
    return joined.select("last_name", "rental_id", "customer_id")


def stage_category(t: Tables, broadcast_limit: int | None = None, copies_first: bool = False) -> DataFrame:
    genres = t["film_category"].select("film_id", "category_id")
    joined = _by_film(t, genres, (t["category"].select("category_id", "name"), "category_id"), broadcast_limit, copies_first)
    return joined.select("name", "rental_id", "customer_id")


def stage_customer(t: Tables, broadcast_limit: int | None = None) -> DataFrame:
    """Payments, not rentals; ``store_id`` is the customer's home store."""
    payment = t["payment"].select("customer_id", "rental_id", "amount")
    payer = t["customer"].select("customer_id", "last_name", "store_id")
    return join_through(payment, (payer, "customer_id"), broadcast_limit=broadcast_limit).select("last_name", "store_id", "rental_id", "amount")


def stage_city(t: Tables, broadcast_limit: int | None = None) -> DataFrame:
    """Payments by the city of the payer's address."""
    payment = t["payment"].select("customer_id", "rental_id", "amount")
    home = t["customer"].select("customer_id", "address_id")
    address = t["address"].select("address_id", "city_id")
    city = t["city"].select("city_id", "city")
    joined = join_through(payment, (home, "customer_id"), (address, "address_id"), (city, "city_id"), broadcast_limit=broadcast_limit)
    return joined.select("city", "rental_id", "amount")


def _of_copies(t: Tables, key: str, dimension: DataFrame, broadcast_limit: int | None) -> DataFrame:
    """Rentals joined to what their copies lead to by ``key``; from the stored join of rentals and copies if a caller supplies it."""
    if RENTED_FILMS in t:
        return join_through(t[RENTED_FILMS].select(key, "rental_id"), (dimension, key), broadcast_limit=broadcast_limit)
    rental, copies = t["rental"].select("inventory_id", "rental_id"), t["inventory"].select("inventory_id", key)
    return join_through(rental, (copies, "inventory_id"), (dimension, key), broadcast_limit=broadcast_limit)


def stage_film(t: Tables, broadcast_limit: int | None = None) -> DataFrame:
    joined = _of_copies(t, "film_id", t["film"].select("film_id", "title", "release_year", "rating"), broadcast_limit)
    return joined.select("title", "release_year", "rating", "rental_id")


def stage_store(t: Tables, broadcast_limit: int | None = None) -> DataFrame:
    """The join to the stores only keeps rentals whose store exists."""
    joined = _of_copies(t, "store_id", t["store"].select("store_id"), broadcast_limit)
    return joined.select("store_id", "rental_id")


STAGES: dict[str, Callable[..., DataFrame]] = {
    "Top_Actor": stage_actor,
    "Top_Category": stage_category,
    "Top_Customer": stage_customer,
    "Top_City": stage_city,
    "Top_Film": stage_film,
    "Top_Store": stage_store,
}
