"""The 15 rental tables as DataFrames over the order tables.

Every table keeps all rows of its base table. A line item is a rental, a part is a film with six
copies, a supplier is an actor or a clerk, an order is a payment. The derivation puts in what real shops have:
names shared by several ids, repeated rental ids, rentals still out, payments without a rental, and copies in
a store (number 5) that is not in the store table. No derivation joins, so none adds a shuffle of a
fact table to the query under test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rentmill.parallel import for_each
from rentmill.schemas import SCHEMAS, TABLES

UPDATED = "TIMESTAMP_NTZ '2006-02-15 09:45:25.123456'"


def _key_of(name: str) -> str:
    """A 52-bit key for a name, the same in every engine that has MD5."""
    return f"conv(substring(md5({name}), 1, 13), 16, 10)"


# Rental table -> base table, rows taken from it, and an expression per column.
DERIVATIONS: dict[str, tuple[str, str, dict[str, str]]] = {
    "actor": ("supplier", "all", {
        "actor_id": "s_suppkey",
        "first_name": "s_name",
        "last_name": "concat('L', s_suppkey % 37)",
    }),
    "address": ("customer", "all", {
        "address_id": "c_custkey",
        "address": "c_name",
        "address2": "c_mktsegment",
        "district": "concat('D', c_nationkey)",
        "city_id": "c_nationkey",
        "postal_code": "concat('0', c_custkey % 1000)",
        "phone": "concat('00', c_custkey)",
    }),
    "category": ("part", "distinct p_type", {"category_id": _key_of("p_type"), "name": "p_type"}),
    "city": ("nation", "all", {"city_id": "n_nationkey", "city": "n_name", "country_id": "n_regionkey"}),
    "country": ("region", "all", {"country_id": "r_regionkey", "country": "r_name"}),
    "customer": ("customer", "all", {
        "customer_id": "c_custkey",
        "store_id": "c_custkey % 5",
        "first_name": "c_name",
        "last_name": "concat('C', c_custkey % 401)",
        "email": "concat(c_name, '@example.org')",
        "address_id": "c_custkey",
        "activebool": "c_acctbal >= 0",
        "create_date": "DATE '2006-02-14'",
        "active": "if(c_acctbal >= 0, 1, 0)",
    }),
    "film": ("part", "all", {
        "film_id": "p_partkey",
        "title": "p_name",
        "description": """concat(p_name, ', a "', p_type, '" part\\nof ', p_brand)""",
        "release_year": "1990 + p_size",
        "language_id": "p_partkey % 4",
        "rental_duration": "3 + p_size % 5",
        "rental_rate": "p_size + 0.99BD",
        "length": "60 + p_size",
        "replacement_cost": "p_retailprice",
        "rating": "p_brand",
        "special_features": "concat('{', p_type, '}')",
        "fulltext": "p_name",
    }),
    # Every supplier that ever shipped a part acts in its film.
    "film_actor": ("lineitem", "distinct l_suppkey l_partkey", {"actor_id": "l_suppkey", "film_id": "l_partkey"}),
    "film_category": ("part", "all", {"film_id": "p_partkey", "category_id": _key_of("p_type")}),
    "inventory": ("part", "six copies", {
        "inventory_id": "p_partkey * 6 + copy",
        "film_id": "p_partkey",
        "store_id": "copy",
    }),
    "language": ("documents", "distinct lang", {"language_id": _key_of("lang"), "name": "lang"}),
    "payment": ("orders", "all", {
        "payment_id": "o_orderkey",
        "customer_id": "o_custkey",
        "staff_id": "o_custkey % 5",
        "rental_id": "if(o_orderstatus = 'P' AND o_orderkey % 10 = 0, NULL, o_orderkey * 10 + 1)",
        "amount": "o_totalprice",
        "payment_date": "o_orderdate",
    }),
    "rental": ("lineitem", "all", {
        "rental_id": "l_orderkey * 10 + l_linenumber",
        "rental_date": "l_shipdate",
        "inventory_id": "l_partkey * 6 + l_suppkey % 6",
        "customer_id": "l_orderkey",
        "return_date": "if(l_returnflag = 'N', NULL, l_shipdate + INTERVAL '3' DAY)",
        "staff_id": "l_suppkey",
        "last_update": "l_shipdate + INTERVAL '4' DAY",
    }),
    "staff": ("supplier", "all", {
        "staff_id": "s_suppkey",
        "first_name": "s_name",
        "last_name": "concat('S', s_nationkey)",
        "address_id": "s_suppkey",
        "email": "concat(s_name, '@example.org')",
        "store_id": "s_nationkey % 5",
        "active": "s_acctbal >= 0",
        "username": "s_name",
        "password": "md5(s_name)",
        "picture": "NULL",
    }),
    "store": ("region", "all", {
        "store_id": "r_regionkey", "manager_staff_id": "r_regionkey", "address_id": "r_regionkey",
    }),
}


# The columns of the base tables that are read. A reader that is given them opens no file to infer a schema.
BASES = {
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz",
    "documents": "lang string",
}


def derive(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One rental table in its declared types."""
    base, rows, columns = DERIVATIONS[table]
    source = spark.read.schema(BASES[base]).parquet(f"{sf_dir}/{base}.parquet")
    if rows.startswith("distinct "):
        source = source.select(*rows.split()[1:]).distinct()
    elif rows == "six copies":
        source = source.selectExpr("p_partkey", "explode(sequence(0, 5)) AS copy")
    return source.selectExpr(
        *(
            f"CAST({columns.get(field.name, UPDATED)} AS {field.dataType.simpleString()}) AS {field.name}"
            for field in SCHEMAS[table].fields
        )
    )


class ShopTables(dict):
    """The rental tables by name, each derived when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, table: str) -> DataFrame:
        self[table] = derive(self.spark, self.sf_dir, table)
        return self[table]

    def all(self) -> dict[str, DataFrame]:
        return dict(zip(TABLES, for_each(self.spark, TABLES, self.__getitem__)))
