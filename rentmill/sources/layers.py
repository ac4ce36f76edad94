"""Tables of a stored layer."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rentmill.parallel import for_each
from rentmill.storage import folder_exists, layer_path
from rentmill.versions import Part, Version, is_plain_folder, newest_version


def read_layer(
    spark: SparkSession, root: str, layer: str, table: str, schema: T.StructType | None = None
) -> DataFrame:
    """The newest version of a stored table, or the content of a plain folder that was never committed.

    A version keeps its schema, so no file is opened to infer one; a declared ``schema`` does the same for a plain folder.
    """
    version = newest_version(spark, root, layer, table)
    if version is None:
        if folder_exists(spark, layer_path(root, layer, table)) and not is_plain_folder(spark, root, layer, table):
            raise ValueError(f"{layer}/{table} has no version yet: its first write has not been committed")
        return (spark.read.schema(schema) if schema else spark.read).parquet(layer_path(root, layer, table))
    return read_parts(spark, root, version, version.parts, schema)


def count_layer(spark: SparkSession, root: str, layer: str, table: str) -> int:
    """Rows of a stored table, as they were counted while its version was written."""
    version = newest_version(spark, root, layer, table)
    return read_layer(spark, root, layer, table).count() if version is None else version.rows


def read_parts(
    spark: SparkSession, root: str, version: Version, parts: Iterable[Part], schema: T.StructType | None = None
) -> DataFrame:
    """The rows of some folders of a version."""
    paths = [f"{root.rstrip('/')}/{part.path}" for part in parts]
    reader = spark.read.schema(schema or version.schema)
    if not paths:
        return spark.createDataFrame([], schema or version.schema)
    if version.partition_by:  # partition folders count from their own part
        return reduce(DataFrame.unionAll, [reader.parquet(path) for path in paths])
    return reader.parquet(*paths)


def read_bucketed(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    """A bucketed table, such that joins and groupings on its bucket column read each bucket in a task and shuffle nothing."""
    version = newest_version(spark, root, layer, table)
    if version is None or not version.buckets:
        raise ValueError(f"{layer}/{table} is not stored in buckets")
    (part,), (column, number) = version.parts, version.buckets
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in version.schema.fields)
    name = f"bucketed_{uuid.uuid4().hex}"
    # Only the catalog can tell Spark of buckets. The name is needed to resolve the table, not to run plans over it.
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{column}`) SORTED BY (`{column}`) INTO {number} BUCKETS "
        f"LOCATION '{root.rstrip('/')}/{part.path}'"
    )
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def load_layer(
    spark: SparkSession, root: str, layer: str, tables: Iterable[str], schemas: Mapping[str, T.StructType] | None = None
) -> dict[str, DataFrame]:
    names, known = list(tables), schemas or {}
    return dict(zip(names, for_each(spark, names, lambda t: read_layer(spark, root, layer, t, known.get(t)))))
