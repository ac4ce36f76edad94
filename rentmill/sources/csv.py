"""CSV folders: one dialect for reading, writing and streaming.

The dialect is the common one: a header row, quotes doubled inside quoted text, line breaks allowed in
quoted text. An empty field is null and a quoted empty field is the empty string.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What the reader puts for a quoted empty field. A text that is this one control character would be read as empty.
EMPTY = "\x01"
DIALECT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_options(schema: T.StructType | None, line_breaks: bool | None = None) -> dict[str, object]:
    """Reader options for a table.

    Only text can hold a line break, and a file that may hold one cannot be split between tasks. The fact
    tables have no text column, so their files stay splittable whatever their size; ``line_breaks=False`` says the
    same of a table whose text is known to have none. A malformed row stops the load instead of turning into nulls.
    """
    if line_breaks is None:
        line_breaks = schema is None or any(isinstance(f.dataType, T.StringType) for f in schema.fields)
    return DIALECT | {"multiLine": line_breaks, "mode": "FAILFAST", "emptyValue": EMPTY}


def restore_empty(df: DataFrame) -> DataFrame:
    """Quoted empty fields, which the reader marks, as empty strings."""
    return df.select(
        *(
            F.when(F.col(f"`{f.name}`") == EMPTY, "").otherwise(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        )
    )


# Columns that a tolerant read adds: the line that does not fit the schema (else null), and the file it is in.
BAD_LINE, FILE = "_bad_line", "_file"


def tolerant(schema: T.StructType) -> T.StructType:
    """The schema of a tolerant read, before the file is added."""
    return T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])


def tolerant_options(schema: T.StructType, line_breaks: bool | None = None) -> dict[str, object]:
    """Reader options under which a malformed row arrives with its line instead of stopping the load."""
    return read_options(schema, line_breaks) | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}


def with_file(df: DataFrame) -> DataFrame:
    """The rows of a tolerant read, empty texts restored, and the path of the file of each."""
    return restore_empty(df.select("*", F.col("_metadata.file_path").alias(FILE)))


def read_csv_tolerantly(spark: SparkSession, path: str, schema: T.StructType, line_breaks: bool | None = None) -> DataFrame:
    """All rows under ``path``, with :data:`BAD_LINE` and :data:`FILE`; see :func:`rentmill.sinks.quarantine.store_accepted`."""
    return with_file(spark.read.options(**tolerant_options(schema, line_breaks)).schema(tolerant(schema)).csv(path))


def read_csv_folder(
    spark: SparkSession, path: str, schema: T.StructType | None = None, line_breaks: bool | None = None
) -> DataFrame:
    """All CSV files under ``path``. Columns bind by position; types are inferred only without a schema."""
    reader = spark.read.options(**read_options(schema, line_breaks))
    return restore_empty((reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path))
