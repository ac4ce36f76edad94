"""What the physical plans look like when nothing is small enough to broadcast."""

from __future__ import annotations

import pytest
from helpers import DATA, bag
from pyspark.sql import functions as F

import __spark_entry__ as driver
from rentmill.fixtures.tables import ShopTables
from rentmill.plans.buckets import bucket_number, bucketed_tables, build_staging_in_buckets, stage_in_buckets, store_buckets
from rentmill.plans.business import rank_directly
from rentmill.plans.staging import STAGES
from rentmill.plans.weekly import weekly_returned
from rentmill.schemas import ACCESS, SCHEMAS, STAGING, TABLES
from rentmill.sinks import write_layer
from rentmill.sources import load_layer, read_layer
from rentmill.versions import newest_version

SF_DIR = f"{DATA}/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def initial_plan(df) -> str:
    return plan(df).split("== Initial Plan ==")[-1]


def test_direct_rankings_combine_before_the_first_shuffle_and_reuse_its_partitioning(spark, setting):
    setting(spark__sql__autoBroadcastJoinThreshold=-1)
    shape = initial_plan(rank_directly("Top_Film", ShopTables(spark, SF_DIR)))
    assert "partial_sum(_count" in shape
    # Per hop one exchange for the counts and one for the links; none is repeated for the join.
    assert shape.count("Exchange hashpartitioning(inventory_id") == 2
    assert shape.count("Exchange hashpartitioning(film_id") == 2
    assert "CartesianProduct" not in shape and "NestedLoop" not in shape


def test_small_dimensions_add_no_shuffle(spark):
    shape = initial_plan(rank_directly("Top_Film", ShopTables(spark, SF_DIR)))
    assert shape.count("BroadcastHashJoin") == 2
    assert shape.count("Exchange hashpartitioning") == 1
    fanned = initial_plan(rank_directly("Top_Actor", ShopTables(spark, SF_DIR)))
    assert "Exchange hashpartitioning(film_id" in fanned


def test_scans_read_only_the_columns_of_the_query(spark):
    shape = plan(weekly_returned(ShopTables(spark, SF_DIR)["rental"]))
    assert "ReadSchema: struct<l_returnflag:string,l_shipdate:timestamp_ntz>" in shape
    assert "partial_count" in shape


@pytest.fixture
def in_buckets(spark, tmp_path):
    """The access tables, facts and links also in buckets."""
    shop, root = ShopTables(spark, SF_DIR), str(tmp_path)
    for table in TABLES:
        write_layer(shop[table], root, ACCESS, table)
    store_buckets(spark, root, number=6)
    return root


@pytest.mark.parametrize("target", STAGES)
def test_facts_in_buckets_are_not_shuffled(spark, setting, in_buckets, target):
    setting(spark__sql__autoBroadcastJoinThreshold=-1, spark__sql__adaptive__autoBroadcastJoinThreshold=-1)
    rows = stage_in_buckets(target, bucketed_tables(spark, in_buckets))
    shape = initial_plan(rows)
    (scan,) = [line for line in shape.split("\n") if "FileScan parquet" in line and "rental_id#" in line]  # only the facts have it
    assert "Bucketed: true" in scan
    assert not exchanges_above(shape, scan), shape
    assert bag(rows) == bag(STAGES[target](ShopTables(spark, SF_DIR)))


def test_links_in_buckets_are_not_shuffled_beside_few_names(spark, setting, in_buckets):
    """With actors small enough to be broadcast, the copies move to the links' buckets and the links stay."""
    tables = bucketed_tables(spark, in_buckets)
    tables["actor"] = F.broadcast(tables["actor"])
    setting(spark__sql__autoBroadcastJoinThreshold=-1, spark__sql__adaptive__autoBroadcastJoinThreshold=-1)
    shape = initial_plan(stage_in_buckets("Top_Actor", tables))
    (links,) = [line for line in shape.split("\n") if "FileScan parquet" in line and "actor_id#" in line and "film_id#" in line]
    assert "Bucketed: true" in links
    assert [e for e in exchanges_above(shape, links) if "film_id" in e] == []


def exchanges_above(shape: str, line: str) -> list[str]:
    """The exchanges between the root of a printed plan and one of its lines."""
    lines = shape.split("\n")
    at = lines.index(line)
    depth = lambda text: len(text) - len(text.lstrip(" :+-"))
    above, least = [], depth(line)
    for other in reversed(lines[:at]):
        if depth(other) < least:
            least = depth(other)
            if "Exchange" in other:
                above.append(other)
    return above


def test_bucketed_tables_are_written_a_file_per_bucket(spark, in_buckets):
    from pathlib import Path

    files = [p.name for p in Path(in_buckets, ACCESS, "rental_bucketed").rglob("*.parquet")]
    assert len(files) == len({name.split("_")[-1] for name in files}) <= 6
    assert read_layer(spark, in_buckets, ACCESS, "rental_bucketed").count() == ShopTables(spark, SF_DIR)["rental"].count()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def test_buckets_grow_in_number_with_the_rows(spark, in_buckets):
    """Links repeated for their copies count too: they meet the facts of a bucket in one task."""
    rows = {table: read_layer(spark, in_buckets, ACCESS, table).count() for table in ("rental", "film_actor", "inventory", "film")}
    repeated = rows["inventory"] * rows["film_actor"] // rows["film"]
    assert repeated > rows["rental"]
    assert bucket_number(spark, in_buckets, 6, repeated) == 6
    assert bucket_number(spark, in_buckets, 6, repeated // 20) == 24
    store_buckets(spark, in_buckets, number=6, bucket_rows=repeated // 20)
    tables = bucketed_tables(spark, in_buckets)
    assert newest_version(spark, in_buckets, ACCESS, "rental_bucketed").buckets == ("inventory_id", 24)
    assert bag(stage_in_buckets("Top_Actor", tables)) == bag(STAGES["Top_Actor"](ShopTables(spark, SF_DIR)))


def test_staging_by_way_of_buckets_is_the_same(spark, in_buckets):
    build_staging_in_buckets(spark, in_buckets, number=3)
    for target in STAGES:
        assert bag(read_layer(spark, in_buckets, STAGING, target)) == bag(STAGES[target](ShopTables(spark, SF_DIR)))


@pytest.fixture
def small_is_large(setting):
    """Broadcast nothing, and call a partition of 20 kB skewed."""
    setting(
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor=2,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20k",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="20k",
    )


def test_staging_moves_the_facts_once_and_never_the_multiplied_rows(spark, setting):
    tables = ShopTables(spark, SF_DIR)
    assert "Exchange hashpartitioning" not in initial_plan(STAGES["Top_Film"](tables))
    setting(spark__sql__autoBroadcastJoinThreshold=-1)
    for target, key in (("Top_Film", "inventory_id"), ("Top_Store", "inventory_id"), ("Top_City", "customer_id")):
        last_join = initial_plan(STAGES[target](tables)).split("SortMergeJoin")[1]
        assert last_join.startswith(f" [{key}")
    shape = initial_plan(STAGES["Top_Actor"](tables))
    joins = [part.split("]")[0] for part in shape.split("SortMergeJoin [")[1:]]
    assert [join.split("#")[0] for join in joins] == ["film_id", "inventory_id", "actor_id"]


def test_a_hot_copy_is_split_in_staging_joins(spark, small_is_large):
    """A third of all rentals are of one copy: adaptive execution splits that partition of the join."""
    tables = ShopTables(spark, SF_DIR).all()
    hot = F.when(F.col("rental_id") % 3 == 0, F.lit(6)).otherwise(F.col("inventory_id"))
    # Several map tasks, since a skewed partition is split along them.
    tables["rental"] = tables["rental"].withColumn("inventory_id", hot).repartition(8, "rental_id")
    rows = STAGES["Top_Film"](tables)
    rows.write.format("noop").mode("overwrite").save()
    staged = rows.collect()
    assert "skew=true" in plan(rows)
    assert len(staged) == tables["rental"].count()


def test_large_links_force_no_broadcast(spark, setting):
    setting(spark__sql__autoBroadcastJoinThreshold=-1)
    tables = ShopTables(spark, SF_DIR)
    shape = initial_plan(rank_directly("Top_Actor", tables, plain_join_bytes=0, hot_links=30))
    assert "SortMergeJoin [film_id" in shape and "_salt" in shape
    assert "Broadcast" not in shape


@pytest.mark.parametrize("target", ["Top_Actor", "Top_Category"])
def test_the_task_that_makes_large_links_does_not_combine_them(spark, setting, target):
    """Copies and genres come from few scanning tasks; their links are dealt out as they come, not held in a table of all of them."""
    setting(spark__sql__autoBroadcastJoinThreshold=-1)
    lines = initial_plan(rank_directly(target, ShopTables(spark, SF_DIR), plain_join_bytes=0, hot_links=30)).split("\n")
    made = [at for at, line in enumerate(lines) if "FileScan parquet [p_partkey" in line]
    assert made
    for at in made:
        over = next(line for line in reversed(lines[:at]) if "HashAggregate" in line or "Exchange" in line)
        assert "Exchange" in over and "_place" in over


@pytest.mark.parametrize("name", ["top_actor", "weekly_returned", "layers_to_access", "append_weekly", "ingest_weekly", "sql_nested"])
def test_queries_leave_the_session_settings_alone(spark, name):
    before = dict(spark.conf.getAll)
    driver.queries()[name](spark, f"{DATA}/sf0.001").count()
    assert dict(spark.conf.getAll) == before


def test_shuffles_of_stored_layers_start_wide_and_are_merged(spark, setting, tmp_path):
    """A ranking and the weekly count over stored layers: the session's width at first, few tasks once sizes are known."""
    setting(spark__sql__adaptive__coalescePartitions__initialPartitionNum=60)
    shop, root = ShopTables(spark, f"{DATA}/sf0.001"), str(tmp_path)
    for table in TABLES:
        write_layer(shop[table], root, ACCESS, table)
    access = load_layer(spark, root, ACCESS, TABLES, SCHEMAS)
    for result in (rank_directly("Top_City", access), weekly_returned(access["rental"])):
        result.collect()
        assert ", 60)" in plan(result) and "AQEShuffleRead coalesced" in plan(result)


def test_declared_schemas_open_no_file(spark, tmp_path):
    root = str(tmp_path)
    write_layer(ShopTables(spark, f"{DATA}/sf0.001")["store"], root, ACCESS, "store")
    assert load_layer(spark, root, ACCESS, ["store"], SCHEMAS)["store"].schema == SCHEMAS["store"]
