"""SQL text over named tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from rentmill.functions import register_functions


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make every table addressable by name for the rest of the session."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def isolated_session(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    functions: Sequence[Callable[[SparkSession], None]] = (register_functions,),
) -> SparkSession:
    """A new session of the same application with the caller's settings and views, in which ``tables`` have their names.

    Names in it are nobody else's: calls of several threads with the same names do not meet, and the caller's own views stay as they
    are. ``functions`` register what SQL may call there; a new session knows none of the caller's temporary functions.
    """
    own = session_like(spark)
    for register in functions:
        register(own)
    named = {name.lower() for name in tables}
    views = [row["viewName"] for row in spark.sql("SHOW VIEWS").collect() if row["isTemporary"]]
    for name in views:
        if name.lower() not in named:
            passed_to(own, spark.table(f"`{name}`")).createOrReplaceTempView(name)
    for name, df in tables.items():
        passed_to(own, df).createOrReplaceTempView(name)
    return own


def session_like(spark: SparkSession) -> SparkSession:
    """A new session of the same application with the settings of ``spark``; what is set there later is set there alone."""
    own = spark.newSession()
    for key, value in dict(spark.conf.getAll).items():
        if own.conf.isModifiable(key) and own.conf.get(key, None) != value:
            own.conf.set(key, value)
    own.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    return own


def passed_to(session: SparkSession, df: DataFrame) -> DataFrame:
    """``df`` in another session, under that session's settings. All sessions see a global view; it goes once its name is resolved."""
    name = f"shared_{uuid.uuid4().hex}"
    df.createGlobalTempView(name)
    try:
        return session.table(f"global_temp.{name}")
    finally:
        df.sparkSession.catalog.dropGlobalTempView(name)


def run_sql(
    spark: SparkSession,
    sql: str,
    tables: Mapping[str, DataFrame],
    functions: Sequence[Callable[[SparkSession], None]] = (register_functions,),
) -> DataFrame:
    """The result of ``sql`` over ``tables`` and the caller's own views, in a session of its own (:func:`isolated_session`)."""
    return isolated_session(spark, tables, functions).sql(sql)
