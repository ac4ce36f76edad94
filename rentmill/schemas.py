"""Declared schemas of the rental shop's tables, and the names of tables and layers.

Keys are 64-bit because a fact table of many terabytes outgrows 32-bit ids, and money columns are wide
enough that a load never turns a large amount into null.
"""

from __future__ import annotations

from pyspark.sql import types as T

LONG, INT, TEXT, BOOL, DATE = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType(), T.DateType()
STAMP, MONEY = T.TimestampNTZType(), T.DecimalType(12, 2)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# The tables' names, columns and column order.
SCHEMAS: dict[str, T.StructType] = {
    "actor": _table(actor_id=LONG, first_name=TEXT, last_name=TEXT, last_update=STAMP),
    "address": _table(
        address_id=LONG, address=TEXT, address2=TEXT, district=TEXT, city_id=LONG, postal_code=TEXT, phone=TEXT,
        last_update=STAMP,
    ),
    "category": _table(category_id=LONG, name=TEXT, last_update=STAMP),
    "city": _table(city_id=LONG, city=TEXT, country_id=LONG, last_update=STAMP),
    "country": _table(country_id=LONG, country=TEXT, last_update=STAMP),
    "customer": _table(
        customer_id=LONG, store_id=LONG, first_name=TEXT, last_name=TEXT, email=TEXT, address_id=LONG,
        activebool=BOOL, create_date=DATE, last_update=STAMP, active=INT,
    ),
    "film": _table(
        film_id=LONG, title=TEXT, description=TEXT, release_year=INT, language_id=LONG, rental_duration=INT,
        rental_rate=MONEY, length=INT, replacement_cost=MONEY, rating=TEXT, last_update=STAMP,
        special_features=TEXT, fulltext=TEXT,
    ),
    "film_actor": _table(actor_id=LONG, film_id=LONG, last_update=STAMP),
    "film_category": _table(film_id=LONG, category_id=LONG, last_update=STAMP),
    "inventory": _table(inventory_id=LONG, film_id=LONG, store_id=LONG, last_update=STAMP),
    "language": _table(language_id=LONG, name=TEXT, last_update=STAMP),
    "payment": _table(
        payment_id=LONG, customer_id=LONG, staff_id=LONG, rental_id=LONG, amount=MONEY, payment_date=STAMP
    ),
    "rental": _table(
        rental_id=LONG, rental_date=STAMP, inventory_id=LONG, customer_id=LONG, return_date=STAMP, staff_id=LONG,
        last_update=STAMP,
    ),
    "staff": _table(
        staff_id=LONG, first_name=TEXT, last_name=TEXT, address_id=LONG, email=TEXT, store_id=LONG, active=BOOL,
        username=TEXT, password=TEXT, last_update=STAMP, picture=TEXT,
    ),
    "store": _table(store_id=LONG, manager_staff_id=LONG, address_id=LONG, last_update=STAMP),
}

TABLES = tuple(SCHEMAS)
# Tables that link many rows to one film.
BRIDGES = ("film_actor", "film_category")

RAW, QUALITY, ACCESS, STAGING, BUSINESS = LAYERS = ("raw", "quality", "access", "staging", "business")

# Column a database scan is split on when the caller names none.
SPLIT_KEYS: dict[str, str] = {
    table: "actor_id" if table == "film_actor" else schema.fieldNames()[0] for table, schema in SCHEMAS.items()
}
