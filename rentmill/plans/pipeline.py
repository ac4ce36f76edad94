"""The whole pipeline, from a source of tables to the rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rentmill.plans.business import RANKINGS
from rentmill.plans.layers import (
    Source, build_business, build_staging, land_tables, layer_report, load_raw, quality_to_access, raw_to_quality,
)
from rentmill.plans.staging import STAGES
from rentmill.schemas import ACCESS, BUSINESS, LAYERS, QUALITY, RAW, STAGING, TABLES

CONTENTS = {RAW: TABLES, QUALITY: TABLES, ACCESS: TABLES, STAGING: tuple(STAGES), BUSINESS: tuple(RANKINGS)}


def run_pipeline(spark: SparkSession, source: Source, root: str, upto: str = BUSINESS) -> DataFrame:
    """Land, load and promote all tables, layer by layer, up to and including ``upto``.

    ``source`` gives the DataFrame of a source table by name. Returns the rows per table written.
    """
    landing = f"{root.rstrip('/')}/landing"

    def land_and_load() -> None:
        land_tables(spark, source, landing)
        load_raw(spark, landing, root)

    steps = {
        RAW: land_and_load,
        QUALITY: lambda: raw_to_quality(spark, root),
        ACCESS: lambda: quality_to_access(spark, root),
        STAGING: lambda: build_staging(spark, root),
        BUSINESS: lambda: build_business(spark, root),
    }
    built = LAYERS[: LAYERS.index(upto) + 1]
    for layer in built:
        steps[layer]()
    return layer_report(spark, root, {layer: CONTENTS[layer] for layer in built})
