"""Storing tables, promoting layers and running the pipeline."""

from __future__ import annotations

from pathlib import Path

import pytest
from helpers import DATA, bag
from pyspark.sql import functions as F

import __spark_entry__ as driver
from rentmill import storage
from rentmill.fixtures.tables import ShopTables
from rentmill.operators import isolated_session, register_views, run_sql
from rentmill.parallel import for_each
from rentmill.functions import register_functions
from rentmill.plans.business import RANKINGS, rank_directly
from rentmill.plans.layers import build_business, build_staging, layer_report, load_raw
from rentmill.plans.pipeline import run_pipeline
from rentmill.plans.staging import RENTED_FILMS, STAGES, rented_films
from rentmill.schemas import ACCESS, BUSINESS, LAYERS, QUALITY, RAW, SCHEMAS, STAGING, TABLES
from rentmill.sinks import query_to_layer, write_layer
from rentmill.sources import load_layer, read_layer

SF_DIR = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def pipeline(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("pipeline"))
    report = run_pipeline(spark, ShopTables(spark, SF_DIR).__getitem__, root)
    return root, {(row.layer, row.table): row.rows for row in report.collect()}


def test_overwrite_replaces_and_append_adds(spark, tmp_path):
    root = str(tmp_path)
    write_layer(spark.range(3), root, RAW, "t")
    write_layer(spark.range(2), root, RAW, "t")
    assert bag(read_layer(spark, root, RAW, "t")) == {(0,): 1, (1,): 1}
    for _ in range(2):
        write_layer(spark.range(2), root, RAW, "t", mode="append")
    assert bag(read_layer(spark, root, RAW, "t")) == {(0,): 3, (1,): 3}
    assert [path.name for path in (tmp_path / RAW).iterdir()] == ["t"]


def test_append_creates_and_refuses_other_columns(spark, tmp_path):
    root = str(tmp_path)
    write_layer(spark.range(1), root, RAW, "t", mode="append")
    with pytest.raises(ValueError, match="cannot append"):
        write_layer(spark.range(1).withColumnRenamed("id", "other"), root, RAW, "t", mode="append")
    with pytest.raises(ValueError, match="mode"):
        write_layer(spark.range(1), root, RAW, "t", mode="ignore")


def test_a_table_can_be_replaced_by_a_query_over_itself(spark, tmp_path):
    root = str(tmp_path)
    write_layer(spark.range(5), root, RAW, "t")
    write_layer(read_layer(spark, root, RAW, "t").where("id > 2"), root, RAW, "t")
    assert bag(read_layer(spark, root, RAW, "t")) == {(3,): 1, (4,): 1}


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    root = str(tmp_path)
    write_layer(spark.range(3), root, RAW, "t")
    failing = spark.range(3).selectExpr("CAST(raise_error('no') AS bigint) AS id")
    with pytest.raises(Exception, match="no"):
        write_layer(failing, root, RAW, "t")
    assert read_layer(spark, root, RAW, "t").count() == 3


def test_partitioned_write(spark, tmp_path):
    root = str(tmp_path)
    write_layer(spark.range(4).selectExpr("id", "id % 2 AS half"), root, RAW, "t", partition_by=["half"])
    assert sorted(path.name for path in (tmp_path / RAW / "t").glob("rows-*/half=*")) == ["half=0", "half=1"]
    write_layer(spark.range(3).selectExpr("id", "id % 2 AS half"), root, RAW, "t", "append", partition_by=["half"])
    assert bag(read_layer(spark, root, RAW, "t")) == {(0, 0): 2, (1, 1): 2, (2, 0): 2, (3, 1): 1}
    with pytest.raises(ValueError, match="cannot append"):
        write_layer(spark.range(3).selectExpr("id", "id % 2 AS half"), root, RAW, "t", "append")


def test_an_empty_table_keeps_its_schema(spark, tmp_path):
    root, empty = str(tmp_path), spark.createDataFrame([], SCHEMAS["film"])
    write_layer(empty, root, RAW, "film")
    assert read_layer(spark, root, RAW, "film").schema == SCHEMAS["film"]
    report = layer_report(spark, root, {RAW: ["film"]})
    assert [tuple(row) for row in report.collect()] == [("raw", "film", 0)]


def test_scratch_space_lies_in_the_folder_the_session_names(spark):
    first, second = storage.scratch_folder(spark, "x"), storage.scratch_folder(spark, "x")
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert first != second and "/rentmill-x-" in first
    assert first.startswith(f"{named.rstrip('/')}/")


def test_a_shared_table_goes_when_its_block_ends(spark):
    with storage.written_once(spark.range(3), "numbers") as numbers:
        (file, *_) = numbers.inputFiles()
        assert numbers.count() == 3 and storage.folder_exists(spark, file)
    assert not storage.folder_exists(spark, file)


class Cluster:
    """A session on a cluster that names no shared folder."""

    class sparkContext:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)

    class conf:
        get = staticmethod(lambda name, default: default)


def test_a_session_without_a_shared_folder_gets_no_local_one():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.scratch_folder(Cluster, "x")


def test_names_of_a_query_are_its_own(spark):
    spark.range(7).createOrReplaceTempView("rental")
    spark.range(5).createOrReplaceTempView("Mine")
    result = run_sql(spark, "SELECT count(*) AS n, (SELECT count(*) FROM mine) AS m FROM rental", {"rental": spark.range(3)})
    assert tuple(result.first()) == (3, 5)
    assert spark.table("rental").count() == 7
    run_sql(spark, "SELECT * FROM film", {"film": spark.range(1)})
    assert not spark.catalog.tableExists("film")
    register_views({"film": spark.range(2)})
    assert spark.table("film").count() == 2
    for name in ("rental", "Mine", "film"):
        spark.catalog.dropTempView(name)
    assert not spark.catalog.listTables("global_temp") or all(not t.name.startswith("shared_") for t in spark.catalog.listTables("global_temp"))


def test_threads_use_one_name_for_different_tables_at_the_same_time(spark):
    from threading import Barrier

    together = Barrier(4, timeout=60)

    def count(n: int) -> int:
        own = isolated_session(spark, {"rental": spark.range(n)})
        together.wait()  # all four have registered the name, none has asked for it
        found = own.sql("SELECT count(*) AS n FROM rental").first().n
        together.wait()
        return found

    assert for_each(spark, range(1, 5), count) == [1, 2, 3, 4]


def test_a_query_runs_under_the_callers_settings(spark, setting):
    setting(spark__sql__session__timeZone="Asia/Tokyo", spark__sql__shuffle__partitions=3)
    result = run_sql(spark, "SELECT current_timezone() AS zone, week_start(TIMESTAMP_NTZ '2005-05-28 10:00:00') AS week", {})
    assert (result.first().zone, str(result.first().week)) == ("Asia/Tokyo", "2005-05-22")
    assert result.sparkSession.conf.get("spark.sql.shuffle.partitions") == "3"


def test_query_to_layer(spark, tmp_path):
    register_functions(spark)
    root, sql = str(tmp_path), "SELECT week_start(at) AS week FROM moments"
    moments = spark.sql("SELECT TIMESTAMP_NTZ '2005-05-28 10:00:00' AS at")
    query_to_layer(spark, sql, root, BUSINESS, "weeks", {"moments": moments})
    assert str(read_layer(spark, root, BUSINESS, "weeks").first().week) == "2005-05-22"


def test_report_names_every_table_of_every_layer(pipeline):
    _, rows = pipeline
    expected = {(layer, table) for layer in (RAW, QUALITY, ACCESS) for table in TABLES}
    assert set(rows) == expected | {(layer, target) for layer in (STAGING, BUSINESS) for target in STAGES}
    assert rows[RAW, "rental"] == rows[ACCESS, "rental"] == 6000


@pytest.mark.parametrize("table", TABLES)
def test_tables_arrive_in_access_unchanged(spark, pipeline, table):
    root, source = pipeline[0], ShopTables(spark, SF_DIR)[table]
    stored = read_layer(spark, root, ACCESS, table)
    if table == "address":
        assert stored.columns == [
            "address_id", "address", "district", "city_id", "postal_code", "phone", "last_update",
        ]
        assert read_layer(spark, root, RAW, table).columns == source.columns
    assert bag(stored) == bag(source.select(*stored.columns))
    assert dict(stored.dtypes).items() <= dict(source.dtypes).items()


def test_business_without_staging_is_the_same(spark, pipeline):
    root, _ = pipeline
    staged = {target: bag(read_layer(spark, root, BUSINESS, target)) for target in RANKINGS}
    tables = load_layer(spark, root, ACCESS, TABLES)
    assert staged == {target: bag(rank_directly(target, tables)) for target in RANKINGS}
    build_business(spark, root, source=ACCESS)
    assert staged == {target: bag(read_layer(spark, root, BUSINESS, target)) for target in RANKINGS}


def test_rerunning_layers_changes_nothing(spark, pipeline):
    root, rows = pipeline
    load_raw(spark, f"{root}/landing", root)
    build_staging(spark, root)
    build_business(spark, root)
    again = layer_report(spark, root, {RAW: TABLES, STAGING: STAGES, BUSINESS: RANKINGS})
    assert {(row.layer, row.table): row.rows for row in again.collect()} == {
        name: n for name, n in rows.items() if name[0] in (RAW, STAGING, BUSINESS)
    }


def test_a_partial_run_stops_where_asked(spark, tmp_path):
    root = str(tmp_path)
    report = run_pipeline(spark, ShopTables(spark, SF_DIR).__getitem__, root, upto=QUALITY)
    assert {row.layer for row in report.collect()} == {RAW, QUALITY}
    assert sorted(path.name for path in tmp_path.iterdir() if path.name in LAYERS) == [QUALITY, RAW]


def test_checksums_sum_longs_and_stay_exact(spark):
    """Digests are summed as longs, not row by row as decimals, and beyond what a long holds."""
    most = (1 << 48) - 1
    digests = spark.range(200_000).select(F.when(F.col("id") < 199_999, F.lit(most)).otherwise(F.lit(5)).alias("digest"))
    total = digests.agg(driver._sum_of_48_bits("digest").alias("total"))
    assert int(total.first().total) == 199_999 * most + 5 > 1 << 63
    plan = total._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and not [part for part in plan.split("partial_sum(")[1:] if "decimal" in part.split("]")[0].lower()]
    assert str(digests.limit(0).agg(driver._sum_of_48_bits("digest").alias("total")).first().total) == "0"


def test_landed_text_is_compressed(pipeline):
    files = [path.name for path in Path(pipeline[0], "landing").rglob("part-*")]
    assert files and all(name.endswith(".csv.gz") for name in files)


@pytest.mark.parametrize("target", ["Top_Actor", "Top_Category", "Top_Film", "Top_Store"])
def test_stages_of_rentals_share_one_join_to_the_copies(spark, target):
    tables = ShopTables(spark, SF_DIR).all()
    shared = STAGES[target](tables | {RENTED_FILMS: rented_films(tables).localCheckpoint()})
    assert "inventory_id" not in shared._jdf.queryExecution().executedPlan().toString()
    assert bag(shared) == bag(STAGES[target](tables))
