"""Session settings. No library call changes them later, so queries of one session do not disturb each other."""

from __future__ import annotations

from pyspark.sql import SparkSession

# A shuffle starts with this many partitions and adaptive execution merges them up to the advisory size, so one value
# serves small and large inputs. Raise it where a single shuffle carries more than INITIAL_PARTITIONS times what one
# task should hold: 20,000 for shuffles of about 5 TB at 256 MB a task.
INITIAL_PARTITIONS = 4_000
ADVISORY_BYTES = 128 << 20
SPLIT_BYTES = 256 << 20

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(
    app: str = "rentmill",
    master: str | None = None,
    *,
    initial_partitions: int = INITIAL_PARTITIONS,
    advisory_bytes: int = ADVISORY_BYTES,
    split_bytes: int = SPLIT_BYTES,
    **settings: str,
) -> SparkSession:
    """A session with the settings above; ``settings`` keys use ``__`` for the dots of a Spark option.

    ``spark.checkpoint.dir`` has to name a folder that the driver and all executors share; scratch tables go there.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sizes = {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial_partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(advisory_bytes),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
    }
    options = SETTINGS | sizes | {name.replace("__", "."): value for name, value in settings.items()}
    for name, value in options.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
