"""Source columns in the declared types of a table: what CSV cannot hold as it is becomes text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def array_text(values: Column) -> Column:
    """An array as the text ``{a,"b c",NULL}``: elements are quoted where their text could be read another way."""

    def element(value: Column) -> Column:
        text = value.cast("string")
        quoted = F.concat(F.lit('"'), F.regexp_replace(text, r'(["\\])', r"\\$1"), F.lit('"'))
        needs_quotes = text.rlike(r'[{},"\\\s]') | (text == "") | (F.upper(text) == "NULL")
        return F.when(text.isNull(), F.lit("NULL")).when(needs_quotes, quoted).otherwise(text)

    return F.when(values.isNotNull(), F.concat(F.lit("{"), F.array_join(F.transform(values, element), ","), F.lit("}")))


def bytes_text(values: Column) -> Column:
    """Bytes as the text ``\\x`` and two hexadecimal digits each."""
    return F.concat(F.lit("\\x"), F.lower(F.hex(values)))


def as_declared(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its types and order. A value that does not fit its type stops the job."""
    columns = []
    for field in schema.fields:
        column, kind = F.col(f"`{field.name}`"), df.schema[field.name].dataType
        if isinstance(kind, T.ArrayType):
            column = array_text(column)
        elif isinstance(kind, T.BinaryType):
            column = bytes_text(column)
        columns.append((column if kind == field.dataType else column.cast(field.dataType)).alias(field.name))
    return df.select(*columns)
