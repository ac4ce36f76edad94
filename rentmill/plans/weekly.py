"""Weekly count of returned rentals, kept current as batches of rentals are added.

A pipeline that adds rentals has a raw table of its own and, named after it, its own summary, so the pipelines do not read
or rewrite each other's tables nor those of the main pipeline. Batches are folders of the raw table, numbered within a
chain (one chain per streaming checkpoint). Beside them lie running counts: those of batch n cover batches 0 to n of its chain.
A refresh reads the running counts before it and the batches since, and the last ones of every chain, never the history.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentmill.functions.dates import week_start
from rentmill.schemas import BUSINESS, RAW, SCHEMAS
from rentmill.sinks.layers import write_layer
from rentmill.sources.csv import read_csv_folder
from rentmill.sources.layers import read_layer
from rentmill.storage import drop_folder, folder_exists, folder_names, layer_path

APPENDED = "rental_appended"
CHAIN, BATCH = "query_id", "batch_id"
COUNTS = "week date, total long"


def summary_of(table: str) -> str:
    """The business table with the weekly counts of the raw table ``table``."""
    return f"weekly_returned_{table}"


def returned(rental: DataFrame) -> DataFrame:
    return rental.where(F.col("return_date").isNotNull())


def weekly_returned(rental: DataFrame) -> DataFrame:
    """Returned rentals per week of the rental date (not of the return), weeks starting on Sunday."""
    return returned(rental).groupBy(week_start("rental_date").alias("week")).agg(F.count(F.lit(1)).alias("total"))


def batch_path(root: str, table: str, chain: str, number: int) -> str:
    return f"{layer_path(root, RAW, table)}/{CHAIN}={chain}/{BATCH}={number}"


def _numbers(spark: SparkSession, chain_path: str) -> list[int]:
    return [int(name.split("=")[1]) for name in folder_names(spark, chain_path, f"{BATCH}=*")]


def _summed(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).groupBy("week").agg(F.sum("total").alias("total"))


def refresh_summary(spark: SparkSession, root: str, table: str, chain: str, number: int) -> None:
    """Bring the running counts of ``chain`` up to batch ``number`` and rebuild the summary.

    Batches that were stored without a refresh are counted now. Done again after a failure it writes the same counts. The
    last two running counts of a chain stay, which a repeated batch needs.
    """
    counts = f"{layer_path(root, RAW, f'{table}_weeks')}"
    own = f"{counts}/{CHAIN}={chain}"
    earlier = [n for n in _numbers(spark, own) if n < number]
    last = max(earlier, default=-1)
    stored = [batch_path(root, table, chain, n) for n in range(last + 1, number + 1)]
    rows = spark.read.schema(SCHEMAS["rental"]).parquet(*(path for path in stored if folder_exists(spark, path)))
    parts = [weekly_returned(rows)]
    if earlier:
        parts.append(spark.read.schema(COUNTS).parquet(f"{own}/{BATCH}={last}"))
    _summed(parts).write.mode("overwrite").parquet(f"{own}/{BATCH}={number}")
    chains = folder_names(spark, counts, f"{CHAIN}=*")
    newest = [f"{counts}/{name}/{BATCH}={max(_numbers(spark, f'{counts}/{name}'))}" for name in chains]
    write_layer(_summed([spark.read.schema(COUNTS).parquet(*newest)]), root, BUSINESS, summary_of(table))
    for n in earlier:
        if n < last:
            drop_folder(spark, f"{own}/{BATCH}={n}")


def read_batches(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All rows added so far, without the folders' bookkeeping columns."""
    return read_layer(spark, root, RAW, table).drop(CHAIN, BATCH)


def append_and_summarise(spark: SparkSession, csv_dir: str, root: str, table: str = APPENDED) -> DataFrame:
    """Append every rental file in ``csv_dir`` to the raw table, refresh its weekly summary and return that.

    Running it twice on the same files counts them twice; :func:`rentmill.streaming.ingest_new_files`
    loads each file once. One append at a time: the next number is the first that no folder has.
    """
    counted = _numbers(spark, f"{layer_path(root, RAW, f'{table}_weeks')}/{CHAIN}=append")
    number = max(counted, default=-1) + 1
    while folder_exists(spark, batch_path(root, table, "append", number)):
        number += 1
    read_csv_folder(spark, csv_dir, SCHEMAS["rental"]).write.parquet(batch_path(root, table, "append", number))
    refresh_summary(spark, root, table, "append", number)
    return read_layer(spark, root, BUSINESS, summary_of(table))
