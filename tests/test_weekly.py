"""Weeks, the weekly summary, and files loaded as they arrive."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from helpers import bag
from pyspark.sql import functions as F

from rentmill.functions import register_functions, week_start
from rentmill.plans.layers import load_raw
from rentmill.plans.weekly import APPENDED, append_and_summarise, read_batches, summary_of, weekly_returned
from rentmill.schemas import BUSINESS, RAW, SCHEMAS
from rentmill.sinks import export_csv, rejected_of
from rentmill.sources import read_layer
from rentmill.storage import folder_names, layer_path
from rentmill.streaming import ingest_new_files, read_ingested, read_rejected
from rentmill.streaming.ingest import INGESTED

RENTAL = SCHEMAS["rental"]
HEADER = ",".join(RENTAL.fieldNames())


def rental_line(n: int, rented: str, returned: str = "") -> str:
    return f"{n},{rented} 10:00:00,1,1,{returned and returned + ' 11:00:00'},1,2006-02-15 21:30:53\n"


def drop_file(folder: Path, name: str, *lines: str) -> None:
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(f"{HEADER}\n" + "".join(lines))


def test_weeks_start_on_sunday(spark):
    days = [dt.datetime(1999, 12, 25) + dt.timedelta(days=n, hours=n % 24) for n in range(3000)]
    register_functions(spark)
    moments = spark.createDataFrame([(day,) for day in days], "at timestamp_ntz")
    moments.createOrReplaceTempView("moments")
    for weeks in (moments.select("at", week_start("at")), spark.sql("SELECT at, week_start(at) FROM moments")):
        for at, week in weeks.collect():
            assert week == (at - dt.timedelta(days=(at.weekday() + 1) % 7)).date()
    spark.catalog.dropTempView("moments")
    dates = spark.sql("SELECT DATE '2005-05-28' AS day, CAST(NULL AS date) AS none")
    assert tuple(dates.select(week_start(F.col("day")), week_start("none")).first()) == (dt.date(2005, 5, 22), None)


def test_weekly_counts_returned_rentals_by_rental_week(spark, shop):
    back = dt.datetime(2005, 7, 1)
    days = [dt.datetime(2005, 5, day, 23, 59) for day in (28, 29, 30)]
    rental = shop(
        rental=("rental_id rental_date return_date", [*((n, day, back) for n, day in enumerate(days)), (9, days[0], None)])
    )["rental"]
    assert bag(weekly_returned(rental)) == {(dt.date(2005, 5, 22), 1): 1, (dt.date(2005, 5, 29), 2): 1}


def test_append_load_counts_a_rerun_again(spark, tmp_path):
    drop_file(tmp_path / "in", "a.csv", rental_line(1, "2005-05-28", "2005-06-01"), rental_line(2, "2005-05-29"))
    for times in (1, 2):
        weekly = append_and_summarise(spark, f"{tmp_path}/in", str(tmp_path))
        assert bag(weekly) == {(dt.date(2005, 5, 22), times): 1}
        assert read_batches(spark, str(tmp_path), APPENDED).count() == 2 * times


@pytest.fixture
def ingest(spark, tmp_path):
    def run(checkpoint: str = "checkpoint", **settings) -> None:
        query = ingest_new_files(
            spark, f"{tmp_path}/in", str(tmp_path), RENTAL, f"{tmp_path}/{checkpoint}", **settings
        )
        query.awaitTermination()

    return run


def test_each_file_is_loaded_once_over_restarts(spark, tmp_path, ingest):
    inbox, expected = tmp_path / "in", {}
    for drop, day in enumerate(("2005-05-28", "2005-05-29", "2005-06-10")):
        drop_file(inbox, f"{drop}a.csv", rental_line(10 * drop, day, "2005-07-01"))
        drop_file(inbox, f"{drop}b.csv", rental_line(10 * drop + 1, day), rental_line(10 * drop + 2, day, "2005-07-01"))
        ingest(max_files_per_batch=1)
        ingest()
        day = dt.date.fromisoformat(day)
        week = day - dt.timedelta(days=(day.weekday() + 1) % 7)
        expected[week, 2] = 1
        assert bag(read_layer(spark, str(tmp_path), BUSINESS, summary_of(INGESTED))) == expected
    loaded = read_ingested(spark, str(tmp_path))
    assert loaded.columns == RENTAL.fieldNames()
    assert sorted(row.rental_id for row in loaded.collect()) == [0, 1, 2, 10, 11, 12, 20, 21, 22]
    batch = spark.read.schema(RENTAL).csv(str(inbox), header=True)
    assert bag(loaded) == bag(batch)


def test_a_batch_that_failed_is_replaced_not_added(spark, tmp_path, ingest, monkeypatch):
    from rentmill.plans import weekly as module

    drop_file(tmp_path / "in", "a.csv", rental_line(1, "2005-05-28", "2005-06-01"))

    def fail(*args, **kwargs):
        raise RuntimeError("lost after the rows were written")

    monkeypatch.setattr(module, "write_layer", fail)
    with pytest.raises(Exception, match="lost after"):
        ingest()
    assert read_ingested(spark, str(tmp_path)).count() == 1
    monkeypatch.undo()
    drop_file(tmp_path / "in", "b.csv", rental_line(2, "2005-05-28", "2005-06-01"))
    ingest()
    assert sorted(row.rental_id for row in read_ingested(spark, str(tmp_path)).collect()) == [1, 2]
    assert bag(read_layer(spark, str(tmp_path), BUSINESS, summary_of(INGESTED))) == {(dt.date(2005, 5, 22), 2): 1}


def test_a_new_checkpoint_does_not_overwrite_earlier_batches(spark, tmp_path, ingest):
    drop_file(tmp_path / "in", "a.csv", rental_line(1, "2005-05-28", "2005-06-01"))
    ingest()
    ingest("another")
    assert read_ingested(spark, str(tmp_path)).count() == 2


def test_an_old_file_that_arrives_late_is_still_loaded(spark, tmp_path, ingest):
    import os

    drop_file(tmp_path / "in", "new.csv", rental_line(1, "2005-05-28"))
    ingest()
    drop_file(tmp_path / "in", "late.csv", rental_line(2, "2005-05-28"))
    os.utime(tmp_path / "in" / "late.csv", (1_000_000_000, 1_000_000_000))
    ingest()
    assert read_ingested(spark, str(tmp_path)).count() == 2


def test_loaded_files_move_to_the_archive(spark, tmp_path, ingest):
    archive = tmp_path / "archive" / "2024-01-31"
    drop_file(tmp_path / "in", "a.csv", rental_line(1, "2005-05-28"))
    ingest(archive_dir=str(archive))
    drop_file(tmp_path / "in", "b.csv", rental_line(2, "2005-05-28"))
    ingest(archive_dir=str(archive))
    assert [path.name for path in archive.rglob("*.csv")] == ["a.csv"]
    assert [path.name for path in (tmp_path / "in").iterdir() if path.suffix == ".csv"] == ["b.csv"]
    assert read_ingested(spark, str(tmp_path)).count() == 2


def test_ingest_equals_a_batch_load_of_an_export(spark, shop, tmp_path, ingest):
    rental = shop(rental=("rental_id rental_date return_date", [(n, dt.datetime(2020, 1, 1, 0, 0, 0, n), None) for n in range(500)]))["rental"]
    export_csv(rental, f"{tmp_path}/in", rows_per_file=20)
    ingest(max_files_per_batch=10, summarise=False)
    assert bag(read_ingested(spark, str(tmp_path))) == bag(rental)


def test_a_refresh_reads_a_bounded_number_of_folders(spark, tmp_path, ingest):
    for n in range(50):
        drop_file(tmp_path / "in", f"{n}.csv", rental_line(n, "2005-05-28", "2005-06-01"))
    ingest(max_files_per_batch=1)
    weeks = layer_path(str(tmp_path), RAW, f"{INGESTED}_weeks")
    (chain,) = folder_names(spark, weeks, "query_id=*")
    assert len(folder_names(spark, f"{weeks}/{chain}", "batch_id=*")) <= 2
    assert bag(read_layer(spark, str(tmp_path), BUSINESS, summary_of(INGESTED))) == {(dt.date(2005, 5, 22), 50): 1}


def test_appends_do_not_read_earlier_ones(spark, tmp_path):
    drop_file(tmp_path / "in", "a.csv", rental_line(1, "2005-05-28", "2005-06-01"))
    for _ in range(3):
        append_and_summarise(spark, f"{tmp_path}/in", str(tmp_path))
    first = layer_path(str(tmp_path), RAW, APPENDED) + "/query_id=append/batch_id=0"
    for file in Path(first).iterdir():
        file.unlink()
    weekly = append_and_summarise(spark, f"{tmp_path}/in", str(tmp_path))
    assert bag(weekly) == {(dt.date(2005, 5, 22), 4): 1}


def test_an_append_that_died_before_its_summary_is_counted_by_the_next(spark, tmp_path, monkeypatch):
    from rentmill.plans import weekly as module

    def dies(*args):
        raise RuntimeError("died")

    drop_file(tmp_path / "in", "a.csv", rental_line(1, "2005-05-28", "2005-06-01"))
    with monkeypatch.context() as patched:
        patched.setattr(module, "refresh_summary", dies)
        with pytest.raises(RuntimeError):
            append_and_summarise(spark, f"{tmp_path}/in", str(tmp_path))
    assert bag(append_and_summarise(spark, f"{tmp_path}/in", str(tmp_path))) == {(dt.date(2005, 5, 22), 2): 1}


def bad_line(n: int) -> str:
    return rental_line(n, "2005-05-28").replace(f"{n},2005-05-28 10:00:00,1,", f"{n},28 May 2005,1,")


def test_a_bad_file_stops_neither_its_run_nor_the_next(spark, tmp_path, ingest):
    folder = tmp_path / "in"
    drop_file(folder, "a.csv", rental_line(1, "2005-05-28", "2005-06-01"))
    drop_file(folder, "b.csv", rental_line(2, "2005-05-28", "2005-06-01"), bad_line(3), "4,short\n", rental_line(5, "2005-05-28", "2005-06-01"))
    (folder / "c.csv").write_bytes(b"\x89PNG\r\n\x1a\n\0\0")
    ingest()
    assert sorted(row.rental_id for row in read_ingested(spark, str(tmp_path)).collect()) == [1, 2, 5]
    rejected = read_rejected(spark, str(tmp_path)).collect()
    assert sorted((Path(row.file).name, row.line.split(",")[0]) for row in rejected if "b.csv" in row.file) == [("b.csv", "3"), ("b.csv", "4")]
    assert '"rental_id":3' in next(row.fields for row in rejected if row.line.startswith("3,"))
    drop_file(folder, "d.csv", rental_line(6, "2005-05-28", "2005-06-01"))
    ingest()
    assert sorted(row.rental_id for row in read_ingested(spark, str(tmp_path)).collect()) == [1, 2, 5, 6]
    assert read_rejected(spark, str(tmp_path)).count() == len(rejected)
    assert bag(read_layer(spark, str(tmp_path), BUSINESS, summary_of(INGESTED))) == {(dt.date(2005, 5, 22), 4): 1}


def test_without_quarantine_a_bad_line_stops_the_run(spark, tmp_path, ingest):
    drop_file(tmp_path / "in", "a.csv", rental_line(1, "2005-05-28"), bad_line(2))
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        ingest(quarantine=False)
    assert read_rejected(spark, str(tmp_path)).count() == 0


def test_a_batch_run_again_rejects_its_lines_once(spark, tmp_path, ingest, monkeypatch):
    from rentmill.streaming import ingest as module

    drop_file(tmp_path / "in", "a.csv", rental_line(1, "2005-05-28", "2005-06-01"), bad_line(2))

    def dies(*args):
        raise RuntimeError("lost after the lines were set aside")

    with monkeypatch.context() as patched:
        patched.setattr(module, "refresh_summary", dies)
        with pytest.raises(Exception, match="lost after"):
            ingest()
    ingest()
    assert read_ingested(spark, str(tmp_path)).count() == 1 and read_rejected(spark, str(tmp_path)).count() == 1


def test_a_load_can_set_bad_lines_aside(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    drop_file(tmp_path / "landing" / "rental", "a.csv", rental_line(1, "2005-05-28"), bad_line(2))
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        load_raw(spark, f"{tmp_path}/landing", str(tmp_path), ["rental"])
    for _ in range(2):
        load_raw(spark, f"{tmp_path}/landing", str(tmp_path), ["rental"], quarantine=True)
        assert [row.rental_id for row in read_layer(spark, str(tmp_path), RAW, "rental").collect()] == [1]
        assert [row.line[:2] for row in read_layer(spark, str(tmp_path), RAW, rejected_of("rental")).collect()] == ["2,"]
    drop_file(tmp_path / "landing" / "rental", "a.csv", rental_line(1, "2005-05-28"))
    load_raw(spark, f"{tmp_path}/landing", str(tmp_path), ["rental"], quarantine=True)
    assert read_layer(spark, str(tmp_path), RAW, rejected_of("rental")).count() == 0
