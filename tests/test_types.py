"""Source types that CSV cannot hold, in the declared types of a table."""

from __future__ import annotations

import datetime as dt

from rentmill.plans.layers import land_tables, load_raw
from rentmill.schemas import RAW, SCHEMAS
from rentmill.sources import read_layer
from rentmill.sources.types import as_declared


def test_arrays_and_bytes_become_text(spark):
    rows = [(["a", "b c", None, "", 'q"\\', "{x}", "null", "1,2"], bytearray(b"\x00\xffA")), ([], bytearray(b"")), (None, None)]
    df = spark.createDataFrame(rows, "features array<string>, picture binary")
    schema = spark.createDataFrame([], "picture string, features string").schema
    got = as_declared(df, schema)
    assert got.schema == schema
    assert [tuple(r) for r in got.collect()] == [
        ("\\x00ff41", '{a,"b c",NULL,"","q\\"\\\\","{x}","null","1,2"}'), ("\\x", "{}"), (None, None),
    ]


def test_landing_casts_to_the_declared_types(spark, tmp_path):
    narrow = spark.sql("SELECT 1 AS category_id, '' AS name, TIMESTAMP '2006-02-15 09:45:25' AS last_update")
    land_tables(spark, lambda table: narrow, f"{tmp_path}/landing", ["category"])
    load_raw(spark, f"{tmp_path}/landing", str(tmp_path), ["category"])
    stored = read_layer(spark, str(tmp_path), RAW, "category")
    assert stored.schema == SCHEMAS["category"]
    assert tuple(stored.first()) == (1, "", dt.datetime(2006, 2, 15, 9, 45, 25))
