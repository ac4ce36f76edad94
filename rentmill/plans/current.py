"""Rankings kept current as batches of rentals and payments are added.

A ranking counts facts per key before it joins anything, and counts of batches add up. So beside each fact table lies a table of
counts per fact key, ``<fact>_counts``, of which every folder holds the counts of some batches. A refresh counts only the
batches that no folder covers yet, adds their folder, and ranks from the counts and the dimensions of now. The folder names the
batches it covers in the commit that adds it: a refresh that is repeated after a failure, or runs beside another one, counts no
batch twice. When ``MOST_FOLDERS`` have gathered they are added up into one, so a refresh reads few rows per key however many
batches there were.

A batch is a folder of a version of the fact table (:mod:`rentmill.versions`). If the table was replaced, so that
covered batches are gone, the counts start again from all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rentmill.operators.counting import sum_counts
from rentmill.parallel import for_each
from rentmill.plans.business import RANKINGS, count_facts, rank_directly
from rentmill.schemas import ACCESS, BUSINESS, SCHEMAS, TABLES
from rentmill.sinks.layers import PartlyHeld, write_layer
from rentmill.sources.layers import load_layer, read_layer, read_parts
from rentmill.versions import Version, newest_version

MOST_FOLDERS = 16
# Fact table -> a ranking whose route starts there.
ROUTES = {ranking.fact: ranking for ranking in RANKINGS.values()}


def counts_of(fact: str) -> str:
    """The business table with the counts per key of a fact table."""
    return f"{fact}_counts"


def add_batch(rows: DataFrame, root: str, fact: str, batch: str) -> None:
    """Add the rows of a batch to a fact table of the access layer, once for each batch id."""
    write_layer(rows, root, ACCESS, fact, mode="append", batches=[batch])


def refresh_counts(spark: SparkSession, root: str, fact: str, most_folders: int = MOST_FOLDERS) -> DataFrame:
    """Bring the counts of a fact table up to its newest version and return them, a key once per folder."""
    table, route = counts_of(fact), ROUTES[fact]
    while True:
        try:
            counts = _with_new_batches(spark, root, fact, table)
            break
        except PartlyHeld:  # another refresh has added some of the batches meanwhile
            continue
    if len(counts.parts) > most_folders:
        whole = sum_counts(read_parts(spark, root, counts, counts.parts), route.fact_key)
        write_layer(whole, root, BUSINESS, table, batches=counts.batches)
    return read_layer(spark, root, BUSINESS, table)


def _with_new_batches(spark: SparkSession, root: str, fact: str, table: str) -> Version:
    """The counts after a folder for the batches that none covers."""
    facts, counts = newest_version(spark, root, ACCESS, fact), newest_version(spark, root, BUSINESS, table)
    if facts is None:
        raise ValueError(f"{ACCESS}/{fact} has no version")
    covered = counts.batches if counts else set()
    lost = covered - {part.path for part in facts.parts}
    new = [part for part in facts.parts if lost or part.path not in covered]
    if counts and not new:
        return counts
    rows = count_facts(ROUTES[fact], {fact: read_parts(spark, root, facts, new)})
    return write_layer(rows, root, BUSINESS, table, "overwrite" if lost else "append", batches=[part.path for part in new])


def refresh_rankings(spark: SparkSession, root: str, most_folders: int = MOST_FOLDERS) -> None:
    """Rebuild the six rankings from counts that are brought up to date first."""
    counts = dict(zip(ROUTES, for_each(spark, ROUTES, lambda fact: refresh_counts(spark, root, fact, most_folders))))
    dimensions = load_layer(spark, root, ACCESS, [table for table in TABLES if table not in ROUTES], SCHEMAS)

    def store(target: str) -> None:
        write_layer(rank_directly(target, dimensions, counts[RANKINGS[target].fact]), root, BUSINESS, target)

    for_each(spark, RANKINGS, store)
