"""Rankings after batches against rankings of the whole, and what a refresh reads."""

from __future__ import annotations

import os

import pytest
from helpers import DATA, bag
from pyspark.sql import functions as F

from rentmill.fixtures.tables import ShopTables
from rentmill.plans import current
from rentmill.plans.business import RANKINGS, rank_directly
from rentmill.plans.current import add_batch, counts_of, refresh_counts, refresh_rankings
from rentmill.schemas import ACCESS, BUSINESS, TABLES
from rentmill.sinks import write_layer
from rentmill.sources import read_layer
from rentmill.versions import newest_version

SF_DIR = f"{DATA}/sf0.001"
KEYS = {"rental": "rental_id", "payment": "payment_id"}


@pytest.fixture
def root(spark, tmp_path):
    shop = ShopTables(spark, SF_DIR)
    for table in TABLES:
        if table not in KEYS:
            write_layer(shop[table], str(tmp_path), ACCESS, table)
    return str(tmp_path)


def batch_of(spark, fact, number, of):
    return ShopTables(spark, SF_DIR)[fact].where(F.col(KEYS[fact]) % of == number)


def test_rankings_follow_the_batches_and_read_only_new_ones(spark, root):
    for number in range(3):
        for fact in KEYS:
            add_batch(batch_of(spark, fact, number, 3), root, fact, f"b{number}")
            add_batch(batch_of(spark, fact, number, 3), root, fact, f"b{number}")
        refresh_rankings(spark, root)
        seen = {fact: ShopTables(spark, SF_DIR)[fact].where(F.col(key) % 3 <= number) for fact, key in KEYS.items()}
        tables = ShopTables(spark, SF_DIR).all() | seen
        for target in RANKINGS:
            assert bag(read_layer(spark, root, BUSINESS, target)) == bag(rank_directly(target, tables))
        for fact in KEYS:  # what has been counted is not needed again
            for part in newest_version(spark, root, ACCESS, fact).parts:
                for file in os.listdir(f"{root}/{part.path}"):
                    os.unlink(f"{root}/{part.path}/{file}")


def test_many_folders_of_counts_become_one(spark, root):
    for number in range(5):
        add_batch(batch_of(spark, "rental", number, 5), root, "rental", str(number))
        counts = refresh_counts(spark, root, "rental", most_folders=2)
        assert len(newest_version(spark, root, BUSINESS, counts_of("rental")).parts) <= 2
    whole = counts.groupBy("inventory_id").agg(F.sum("_count"))
    assert bag(whole) == bag(ShopTables(spark, SF_DIR)["rental"].groupBy("inventory_id").agg(F.count("rental_id")))
    assert len(newest_version(spark, root, BUSINESS, counts_of("rental")).batches) == 5


def test_a_repeated_refresh_counts_nothing_twice(spark, root, monkeypatch):
    add_batch(batch_of(spark, "rental", 0, 2), root, "rental", "0")
    first = refresh_counts(spark, root, "rental").agg(F.sum("_count")).first()
    stale = newest_version(spark, root, BUSINESS, counts_of("rental"))
    assert refresh_counts(spark, root, "rental").agg(F.sum("_count")).first() == first
    add_batch(batch_of(spark, "rental", 1, 2), root, "rental", "1")
    refresh_counts(spark, root, "rental")
    # A second refresh that looked before the first one committed finds its batches there.
    looked = current.newest_version
    monkeypatch.setattr(current, "newest_version", lambda s, r, layer, table: stale if layer == BUSINESS else looked(s, r, layer, table))
    again = refresh_counts(spark, root, "rental").agg(F.sum("_count")).first()
    assert again[0] == ShopTables(spark, SF_DIR)["rental"].count()


def test_a_replaced_table_is_counted_anew(spark, root):
    add_batch(batch_of(spark, "rental", 0, 2), root, "rental", "0")
    refresh_counts(spark, root, "rental")
    write_layer(batch_of(spark, "rental", 1, 2), root, ACCESS, "rental")
    counts = refresh_counts(spark, root, "rental")
    assert bag(counts) == bag(batch_of(spark, "rental", 1, 2).groupBy("inventory_id").agg(F.count("rental_id")))
    write_layer(batch_of(spark, "rental", 1, 2).where("false"), root, ACCESS, "rental")
    assert refresh_counts(spark, root, "rental").count() == 0
