"""Building one layer from the one before."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession

from rentmill.parallel import for_each
from rentmill.plans.business import RANKINGS, count_facts, rank, rank_directly
from rentmill.plans.staging import RENTED_FILMS, STAGES, rented_films
from rentmill.schemas import ACCESS, BUSINESS, QUALITY, RAW, SCHEMAS, STAGING, TABLES
from rentmill.sinks.csv import export_csv
from rentmill.sinks.layers import write_layer
from rentmill.sinks.quarantine import rejected_of, store_accepted
from rentmill.sources.csv import read_csv_folder, read_csv_tolerantly
from rentmill.sources.types import as_declared
from rentmill.sources.layers import count_layer, load_layer, read_layer
from rentmill.storage import written_once
from rentmill.versions import commit_unchanged

Source = Callable[[str], DataFrame]
Rules = Mapping[str, Callable[[DataFrame], DataFrame]]


# The address columns kept from the quality layer on. The second address line goes.
ADDRESS_COLUMNS = ("address_id", "address", "district", "city_id", "postal_code", "phone", "last_update")


def quality_address(address: DataFrame) -> DataFrame:
    return address.select(*ADDRESS_COLUMNS)


QUALITY_RULES: Rules = {"address": quality_address}


def project(table: str, df: DataFrame, rules: Rules) -> DataFrame:
    """``df`` through the table's rule, unchanged if it has none."""
    return rules[table](df) if table in rules else df


def store_tables(
    spark: SparkSession, source: Source, root: str, layer: str, tables: Iterable[str] = TABLES
) -> None:
    """Replace tables of a layer with what ``source`` gives for their names."""
    for_each(spark, tables, lambda table: write_layer(source(table), root, layer, table))


def land_tables(spark: SparkSession, source: Source, landing: str, tables: Iterable[str] = TABLES) -> None:
    """Export every source table, in its declared types, to a CSV folder of its own; the text is compressed to a fraction."""

    def land(table: str) -> None:
        export_csv(as_declared(source(table), SCHEMAS[table]), f"{landing}/{table}", compression="gzip")

    for_each(spark, tables, land)


def load_raw(
    spark: SparkSession, landing: str, root: str, tables: Iterable[str] = TABLES, *, quarantine: bool = False
) -> None:
    """Load every CSV folder into the raw layer under its declared schema.

    A malformed line stops the load; with ``quarantine`` it goes to the raw table ``<table>_rejected``, which holds the lines of the last load.
    """

    def load(table: str) -> None:
        folder, schema = f"{landing}/{table}", SCHEMAS[table]
        if not quarantine:
            write_layer(read_csv_folder(spark, folder, schema), root, RAW, table)
            return

        def reject(lines: DataFrame) -> None:
            write_layer(lines, root, RAW, rejected_of(table))

        rows = read_csv_tolerantly(spark, folder, schema)
        if not store_accepted(rows, lambda sound: write_layer(sound, root, RAW, table), reject):
            reject(spark.createDataFrame([], "file string, line string, fields string"))

    for_each(spark, tables, load)


def promote(
    spark: SparkSession, root: str, source: str, target: str, rules: Rules, tables: Iterable[str] = TABLES
) -> None:
    """Take every table from one layer to the next, through its rule if it has one.

    A table without a rule is the same in both layers, so the version of the layer below is committed again and no row is copied.
    """

    def take(table: str) -> None:
        if table in rules or not commit_unchanged(spark, root, source, target, table):
            write_layer(project(table, read_layer(spark, root, source, table), rules), root, target, table)

    for_each(spark, tables, take)


def raw_to_quality(spark: SparkSession, root: str, rules: Rules = QUALITY_RULES) -> None:
    promote(spark, root, RAW, QUALITY, rules)


def quality_to_access(spark: SparkSession, root: str, rules: Rules | None = None) -> None:
    promote(spark, root, QUALITY, ACCESS, rules or {})


def build_staging(spark: SparkSession, root: str) -> None:
    """Write the six staging tables.

    Four of them start from the join of rentals to their copies, which is written once and read by each.
    """
    tables = load_layer(spark, root, ACCESS, TABLES, SCHEMAS)
    with written_once(rented_films(tables), RENTED_FILMS) as films:
        tables[RENTED_FILMS] = films
        for_each(spark, STAGES, lambda target: write_layer(STAGES[target](tables), root, STAGING, target))


def build_business(spark: SparkSession, root: str, source: str = STAGING) -> None:
    """Write the six rankings, from the staging layer or (``source="access"``) without it.

    Without staging each fact table is read once, to count it per key; all rankings go on from the counts.
    """
    def store(rankings: Mapping[str, DataFrame]) -> None:
        for_each(spark, rankings, lambda target: write_layer(rankings[target], root, BUSINESS, target))

    if source == STAGING:
        stages = load_layer(spark, root, STAGING, RANKINGS)
        store({target: rank(target, stages[target]) for target in RANKINGS})
        return
    tables = load_layer(spark, root, source, TABLES, SCHEMAS)
    routes = {ranking.fact: ranking for ranking in RANKINGS.values()}
    with ExitStack() as shared:

        def counted(fact: str) -> DataFrame:
            return shared.enter_context(written_once(count_facts(routes[fact], tables), f"{fact}_counts"))

        counts = dict(zip(routes, for_each(spark, routes, counted)))
        store({target: rank_directly(target, tables, counts[r.fact]) for target, r in RANKINGS.items()})


def layer_report(spark: SparkSession, root: str, layers: Mapping[str, Iterable[str]]) -> DataFrame:
    """Rows of every stored table, as (layer, table, rows): those that were counted while the versions were written."""
    names = [(layer, table) for layer, tables in layers.items() for table in tables]

    counted = zip(names, for_each(spark, names, lambda name: count_layer(spark, root, *name)))
    return spark.createDataFrame([(*name, n) for name, n in counted], "layer string, table string, rows long")
