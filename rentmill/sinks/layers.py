"""Writing tables into a layer."""

from __future__ import annotations

import uuid
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rentmill.operators.views import run_sql
from rentmill.storage import drop_folder, layer_path
from rentmill.versions import Part, Version, commit, is_plain_folder, new_folder, newest_version


class PartlyHeld(ValueError):
    """Some of the batches to append are in the table, so their folder cannot be added as a whole."""


def write_layer(
    df: DataFrame,
    root: str,
    layer: str,
    table: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    *,
    batches: Collection[str] = (),
    bucket_by: tuple[str, int] | None = None,
) -> Version:
    """Store ``df`` as ``table`` of ``layer``, creating it if needed, and return the committed version.

    ``overwrite`` commits only the new rows, so ``df`` may itself read the table it replaces. ``append`` adds rows, again on
    every rerun, and refuses other columns; with the ids of the ``batches`` it consists of it adds them only if the table does
    not hold them yet. ``bucket_by`` (column, number) stores the rows bucketed and sorted by a column; a bucketed
    table is overwritten, not appended to. Rows are counted while they are written.
    """
    spark = df.sparkSession
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode}")
    if mode == "append":
        held = newest_version(spark, root, layer, table)
        if held is None and is_plain_folder(spark, root, layer, table):
            raise ValueError(f"{layer_path(root, layer, table)} is a plain folder; overwrite it before appending")
        if held:
            _require_fit(df, held, partition_by, f"{layer}/{table}")
            if _holds(held, batches):
                return held
    part = _write_rows(df, root, new_folder(layer, table), partition_by, batches, bucket_by)
    added = Version(df.schema, (part,), tuple(partition_by), bucket_by)

    def change(old: Version | None) -> Version | None:
        if mode == "overwrite" or old is None:
            return added
        _require_fit(df, old, partition_by, f"{layer}/{table}")
        if _holds(old, batches):
            return None
        return Version(old.schema, (*old.parts, part), old.partition_by)

    version = commit(spark, root, layer, table, change)
    if part not in version.parts:  # another writer has added the batch meanwhile
        drop_folder(spark, f"{root.rstrip('/')}/{part.path}")
    return version


def _write_rows(
    df: DataFrame, root: str, folder: str, partition_by: Sequence[str], batches: Collection[str], bucket_by: tuple[str, int] | None
) -> Part:
    """Write a folder and count its rows on the way. The count is taken in the tasks that write, each of which counts once."""
    counted = Observation(folder)
    path = f"{root.rstrip('/')}/{folder}"
    if bucket_by:  # rows of a bucket in one task, so a bucket is one file
        df = df.repartition(bucket_by[1], bucket_by[0])
    writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).write.partitionBy(*partition_by)
    if bucket_by:
        column, number = bucket_by
        name = f"bucketed_{uuid.uuid4().hex}"
        # Spark writes buckets only through its catalog; the table is external, and only its folder stays.
        writer.bucketBy(number, column).sortBy(column).option("path", path).format("parquet").saveAsTable(name)
        df.sparkSession.sql(f"DROP TABLE {name}")
    else:
        writer.parquet(path)
    return Part(folder, counted.get["rows"], tuple(sorted(batches)))


def _holds(held: Version, batches: Collection[str]) -> bool:
    """Whether all batches are there; an error if only some are."""
    known = held.batches.intersection(batches)
    if known and known != set(batches):
        raise PartlyHeld(f"of the batches to append some are there: {sorted(known)}")
    return bool(known)


def _require_fit(df: DataFrame, held: Version, partition_by: Sequence[str], target: str) -> None:
    ours, theirs = sorted(df.dtypes), sorted((f.name, f.dataType.simpleString()) for f in held.schema.fields)
    if ours != theirs:
        raise ValueError(f"{target} holds {theirs}; cannot append {ours}")
    if held.buckets or held.partition_by != tuple(partition_by):
        raise ValueError(f"{target} is stored by {held.buckets or held.partition_by}; cannot append by {tuple(partition_by)}")


def query_to_layer(
    spark: SparkSession, sql: str, root: str, layer: str, table: str, tables: Mapping[str, DataFrame] | None = None
) -> None:
    """Replace ``table`` with the result of ``sql``, run over ``tables`` and the session's own views."""
    write_layer(run_sql(spark, sql, tables or {}), root, layer, table)
