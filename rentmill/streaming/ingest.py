"""Files loaded once each as they arrive, with a weekly summary kept current."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rentmill.plans.weekly import batch_path, read_batches, refresh_summary
from rentmill.schemas import RAW
from rentmill.sinks.layers import write_layer
from rentmill.sinks.quarantine import rejected_of, store_accepted
from rentmill.sources.csv import read_options, restore_empty, tolerant, tolerant_options, with_file
from rentmill.sources.layers import read_layer
from rentmill.versions import newest_version

INGESTED = "rental_ingest"
# The file source forgets, and then skips, files older than this against the newest. This default forgets nothing.
ANY_AGE = "36500d"


def ingest_new_files(
    spark: SparkSession,
    in_dir: str,
    root: str,
    schema: T.StructType,
    checkpoint: str,
    archive_dir: str | None = None,
    *,
    table: str = INGESTED,
    summarise: bool = True,
    max_files_per_batch: int | None = None,
    max_file_age: str = ANY_AGE,
    quarantine: bool = True,
) -> StreamingQuery:
    """Append the files of ``in_dir`` that ``checkpoint`` has not seen yet, then stop.

    Each batch goes to a folder named after the query and the batch, written with overwrite: a batch that is
    run again after a failure replaces its first attempt. With ``summarise`` the summary of ``table`` is refreshed
    (:func:`rentmill.plans.weekly.refresh_summary`), which also counts batches stored without it.

    A malformed line does not stop the run: it goes to the raw table ``<table>_rejected`` with its file, once however often its
    batch is run, and the other lines of the file are loaded. With ``quarantine=False`` it stops this run and every later
    one, until the file is mended.

    With ``archive_dir`` the file source moves loaded files there during a later run that finds new files.
    A file name already loaded is not loaded again, whatever it holds. The source remembers the names of files no older
    than ``max_file_age`` (against the newest file). A folder that receives files for years should be archived and have an
    age longer than any file is late: then both the folder and what the driver remembers stay bounded.
    """
    options = tolerant_options(schema) if quarantine else read_options(schema)
    reader = spark.readStream.schema(tolerant(schema) if quarantine else schema).options(**options).option("maxFileAge", max_file_age)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # A new checkpoint numbers its batches from 0 again; the query's id keeps them apart.
        query_id = session.sparkContext.getLocalProperty("sql.streaming.queryId")

        def store(rows: DataFrame) -> None:
            rows.write.mode("overwrite").parquet(batch_path(root, table, query_id, batch_id))

        def reject(lines: DataFrame) -> None:
            write_layer(lines, root, RAW, rejected_of(table), mode="append", batches=[f"{query_id}/{batch_id}"])

        if quarantine:
            store_accepted(batch, store, reject)
        else:
            store(batch)
        if summarise:
            refresh_summary(session, root, table, query_id, batch_id)

    files = reader.csv(in_dir)
    return (
        (with_file(files) if quarantine else restore_empty(files))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_ingested(spark: SparkSession, root: str, table: str = INGESTED) -> DataFrame:
    """All rows loaded so far, without the folders' bookkeeping columns."""
    return read_batches(spark, root, table)


def read_rejected(spark: SparkSession, root: str, table: str = INGESTED) -> DataFrame:
    """The malformed lines met so far: ``file``, ``line`` and, as JSON, the ``fields`` that could be read."""
    name = rejected_of(table)
    if newest_version(spark, root, RAW, name) is None:
        return spark.createDataFrame([], "file string, line string, fields string")
    return read_layer(spark, root, RAW, name)
