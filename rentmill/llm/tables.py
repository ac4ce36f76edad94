"""Tables shared by the operators of this subpackage: reading the inputs, and cutting lineage with written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentmill.operators.views import passed_to, session_like
from rentmill.storage import drop_folder, scratch_folder

# White space as the contracts of this subpackage define it, and a word: a maximal run of anything else.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to shared scratch space under ``spark.checkpoint.dir`` and read back.

    A written table survives the loss of executors, is not computed again by its second reader, and goes when
    the session ends.
    """
    path = f"{scratch_folder(df.sparkSession, label)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the folders of :func:`stored` tables that nothing reads any more."""
    for table in tables:
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            drop_folder(table.sparkSession, folder.rsplit("/", 1)[0])


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ARROW_BYTES, MOST_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "1m"


def small_batches(df: DataFrame) -> DataFrame:
    """``df`` in a session of its own, whose Arrow batches to Python end at 1 MB and not only at a number of rows.

    10,000 whole texts at once are held by the executor's JVM and again by its Python worker, and neither gives all of it back.
    """
    own = session_like(df.sparkSession)
    own.conf.set(ARROW_BYTES, MOST_ARROW_BYTES)
    return passed_to(own, df)


def tidy(df: DataFrame) -> DataFrame:
    """``df`` in a session of its own, in which the shuffle files of a query go when the query ends, and with :func:`small_batches`.

    Steps whose results are stored or collected then never hold more than one step's shuffles on the executors' disks. Elsewhere
    the files stay until the driver's JVM collects what refers to them, which may be never. A result that its caller may run
    several times has to be handed back to the caller's session (``passed_to``).
    """
    own = session_like(df.sparkSession)
    own.conf.set(FREE_SHUFFLES, "true")
    own.conf.set(ARROW_BYTES, MOST_ARROW_BYTES)
    return passed_to(own, df)


def text_of(column: str = "text"):
    """The text, null counting as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def held_out(doc_id: str, modulus: int, remainder: int):
    """Whether a row is kept from training, by the CRC-32 of its id written in decimal; a null id is."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % modulus == remainder, F.lit(True))


def bounded_sample(rows: DataFrame, key: str, bound: int, count: int) -> DataFrame:
    """About ``bound`` of the ``count`` rows, chosen by a hash of the key, or all if they are fewer."""
    if count <= bound:
        return rows
    return rows.where(F.pmod(F.xxhash64(key), F.lit(1 << 40)) < int(bound / count * (1 << 40)))
