"""Versions of stored tables: commits, readers in between, writers at once, batches, references and cleaning."""

from __future__ import annotations

import os

import pytest
from helpers import bag

from rentmill import storage, versions
from rentmill.parallel import for_each
from rentmill.plans.layers import layer_report, promote, quality_address
from rentmill.schemas import ACCESS, QUALITY, RAW
from rentmill.sinks import write_layer
from rentmill.sources import read_layer
from rentmill.versions import newest_version, vacuum


@pytest.fixture
def no_renames(monkeypatch):
    """A file system on which the library may rename nothing, as on an object store."""

    def refuse(*args):
        raise AssertionError("renamed")

    monkeypatch.setattr(storage, "_rename", refuse)


@pytest.fixture(params=["link", "create"])
def creation(request, monkeypatch):
    """Commit files made by hard links, and by the file system's own creation."""
    if request.param == "create":
        real = storage._locate

        class Plain:
            """The local file system under another scheme."""

            def __init__(self, files):
                self.files = files

            def getScheme(self):
                return "other"

            def __getattr__(self, name):
                return getattr(self.files, name)

        monkeypatch.setattr(storage, "_locate", lambda spark, path: (lambda p, f: (p, Plain(f)))(*real(spark, path)))


def data_files(folder) -> set[str]:
    return {str(path) for path in folder.rglob("*.parquet")}


def test_a_reader_keeps_its_version_while_the_table_is_replaced(spark, tmp_path, no_renames):
    root = str(tmp_path)
    write_layer(spark.range(3), root, RAW, "t")
    before = read_layer(spark, root, RAW, "t")
    write_layer(spark.range(10), root, RAW, "t")
    assert before.count() == 3 and read_layer(spark, root, RAW, "t").count() == 10
    write_layer(spark.range(2), root, RAW, "t", mode="append")
    assert before.count() == 3 and read_layer(spark, root, RAW, "t").count() == 12


def test_two_overwrites_at_once_leave_one_whole_table(spark, tmp_path, no_renames):
    root = str(tmp_path)
    write_layer(spark.range(1), root, RAW, "t")
    for_each(spark, range(2, 8), lambda n: write_layer(spark.range(n), root, RAW, "t"))
    assert read_layer(spark, root, RAW, "t").count() in range(2, 8)
    assert newest_version(spark, root, RAW, "t").number == 6


def test_appends_at_once_all_arrive(spark, tmp_path, no_renames):
    root = str(tmp_path)
    for_each(spark, range(8), lambda n: write_layer(spark.range(n, n + 1), root, RAW, "t", mode="append"))
    assert bag(read_layer(spark, root, RAW, "t")) == {(n,): 1 for n in range(8)}
    assert newest_version(spark, root, RAW, "t").rows == 8


def test_an_append_is_built_on_the_commit_that_came_first(spark, tmp_path, monkeypatch):
    root, create = str(tmp_path), versions.create_file
    write_layer(spark.range(3), root, RAW, "t")

    def overtaken(*args):
        monkeypatch.setattr(versions, "create_file", create)
        write_layer(spark.range(7), root, RAW, "t")
        return create(*args)

    monkeypatch.setattr(versions, "create_file", overtaken)
    write_layer(spark.range(2), root, RAW, "t", mode="append")
    assert read_layer(spark, root, RAW, "t").count() == 9


def test_a_writer_that_died_before_its_commit_changed_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    write_layer(spark.range(3), root, RAW, "t")

    def dies(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(versions, "create_file", dies)
        with pytest.raises(KeyboardInterrupt):
            write_layer(spark.range(9), root, RAW, "t")
    assert read_layer(spark, root, RAW, "t").count() == 3
    write_layer(spark.range(2), root, RAW, "t", mode="append")
    assert read_layer(spark, root, RAW, "t").count() == 5


def test_rows_of_a_first_write_are_not_read_before_its_commit(spark, tmp_path, monkeypatch):
    root, create = str(tmp_path), versions.create_file

    def early(*args):
        with pytest.raises(ValueError, match="not been committed"):
            read_layer(spark, root, RAW, "t")
        return create(*args)

    monkeypatch.setattr(versions, "create_file", early)
    write_layer(spark.range(2), root, RAW, "t", mode="append")
    assert read_layer(spark, root, RAW, "t").count() == 2


def test_a_half_written_commit_is_waited_for_and_then_passed_over(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    write_layer(spark.range(3), root, RAW, "t")
    half = tmp_path / RAW / "t" / "_commits" / f"{1:020d}.json"
    half.write_text('{"schema": ')
    monkeypatch.setattr(versions, "PATIENCE", 0.3)
    assert read_layer(spark, root, RAW, "t").count() == 3
    write_layer(spark.range(2), root, RAW, "t", mode="append")
    assert read_layer(spark, root, RAW, "t").count() == 5
    assert newest_version(spark, root, RAW, "t").number == 2
    monkeypatch.setattr(versions, "PATIENCE", 30)
    done = (tmp_path / RAW / "t" / "_commits" / f"{2:020d}.json").read_text()
    late = tmp_path / RAW / "t" / "_commits" / f"{3:020d}.json"
    late.write_text(done[:10])
    monkeypatch.setattr(versions.time, "sleep", lambda seconds: late.write_text(done))
    assert newest_version(spark, root, RAW, "t").number == 3


def test_of_two_files_of_one_name_the_first_stays(spark, tmp_path, creation):
    path = f"{tmp_path}/c/1.json"
    assert storage.create_file(spark, path, "mine") and not storage.create_file(spark, path, "other")
    assert storage.read_file(spark, path) == "mine"


def test_an_append_of_one_batch_is_made_once(spark, tmp_path):
    root = str(tmp_path)
    for batch in ("a", "a", "b", "a", "b"):
        write_layer(spark.range(2), root, RAW, "t", mode="append", batches=[batch])
    assert read_layer(spark, root, RAW, "t").count() == 4
    for_each(spark, range(4), lambda _: write_layer(spark.range(5), root, RAW, "t", mode="append", batches=["c"]))
    assert read_layer(spark, root, RAW, "t").count() == 9
    assert len(list((tmp_path / RAW / "t").glob("rows-*"))) == 3
    with pytest.raises(ValueError, match="some are there"):
        write_layer(spark.range(5), root, RAW, "t", mode="append", batches=["c", "d"])
    for _ in range(2):
        write_layer(spark.range(2), root, RAW, "t", mode="append")
    assert read_layer(spark, root, RAW, "t").count() == 13


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    root = str(tmp_path)
    write_layer(spark.range(1000).repartition(7).where("id % 3 = 0"), root, RAW, "t")
    write_layer(spark.range(10).where("id < 0"), root, RAW, "none")
    write_layer(spark.createDataFrame([], "a long"), root, RAW, "empty")
    write_layer(spark.range(100).selectExpr("id", "id % 5 AS k"), root, RAW, "b", bucket_by=("k", 4))
    assert [newest_version(spark, root, RAW, t).rows for t in ("t", "none", "empty", "b")] == [334, 0, 0, 100]


def test_the_report_runs_no_job_over_the_tables(spark, tmp_path):
    root = str(tmp_path)
    for table in ("a", "b"):
        write_layer(spark.range(4), root, RAW, table)
    write_layer(spark.range(4), root, RAW, "b", mode="append")
    for file in data_files(tmp_path):
        os.unlink(file)
    assert bag(layer_report(spark, root, {RAW: ["a", "b"]})) == {("raw", "a", 4): 1, ("raw", "b", 8): 1}


def test_promotion_without_a_rule_writes_no_data_file(spark, tmp_path):
    root, columns = str(tmp_path), "address_id address address2 district city_id postal_code phone last_update".split()
    rows = spark.range(4).selectExpr(*(f"id AS {c}" for c in columns))
    write_layer(spark.range(9), root, RAW, "t")
    write_layer(rows, root, RAW, "address")
    before = data_files(tmp_path)
    promote(spark, root, RAW, QUALITY, {}, ["t"])
    promote(spark, root, QUALITY, ACCESS, {}, ["t"])
    assert data_files(tmp_path) == before
    assert read_layer(spark, root, ACCESS, "t").count() == 9
    promote(spark, root, RAW, QUALITY, {"address": quality_address}, ["address"])
    assert len(data_files(tmp_path / QUALITY)) > 0 and "address2" not in read_layer(spark, root, QUALITY, "address").columns
    promote(spark, root, RAW, QUALITY, {}, ["t"])
    assert newest_version(spark, root, QUALITY, "t").number == 0, "a promotion that changes nothing commits nothing"


def test_layers_that_share_folders_go_their_own_ways(spark, tmp_path):
    root = str(tmp_path)
    write_layer(spark.range(9), root, RAW, "t")
    promote(spark, root, RAW, QUALITY, {}, ["t"])
    write_layer(spark.range(2), root, RAW, "t")
    assert read_layer(spark, root, QUALITY, "t").count() == 9
    write_layer(spark.range(1), root, QUALITY, "t", mode="append")
    assert read_layer(spark, root, RAW, "t").count() == 2 and read_layer(spark, root, QUALITY, "t").count() == 10


def test_vacuum_keeps_what_any_layer_needs(spark, tmp_path):
    root = str(tmp_path)
    write_layer(spark.range(9), root, RAW, "t")
    promote(spark, root, RAW, QUALITY, {}, ["t"])
    for n in (1, 2, 3):
        write_layer(spark.range(n), root, RAW, "t")
    assert vacuum(spark, root, [RAW, QUALITY], older_than=3600) == []
    assert len(vacuum(spark, root, [RAW, QUALITY], older_than=-1)) == 2
    assert read_layer(spark, root, RAW, "t").count() == 3 and read_layer(spark, root, QUALITY, "t").count() == 9
    promote(spark, root, RAW, QUALITY, {}, ["t"])
    assert len(vacuum(spark, root, [RAW, QUALITY], older_than=-1)) == 1
    assert read_layer(spark, root, QUALITY, "t").count() == 3
    write_layer(spark.range(5), root, RAW, "t", mode="append")
    assert read_layer(spark, root, RAW, "t").count() == 8


def test_a_plain_folder_is_read_and_replaced_but_not_appended_to(spark, tmp_path):
    root = str(tmp_path)
    spark.range(4).write.parquet(f"{root}/raw/t")
    assert read_layer(spark, root, RAW, "t").count() == 4
    with pytest.raises(ValueError, match="plain folder"):
        write_layer(spark.range(1), root, RAW, "t", mode="append")
    write_layer(spark.range(6), root, RAW, "t")
    assert read_layer(spark, root, RAW, "t").count() == 6
