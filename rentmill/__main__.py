"""Runs one step of the pipeline as a Spark job: ``python -m rentmill STEP --root FOLDER``.

Steps, in order: land, load, quality, access, staging, business. ``all`` runs them one after the other, ``weekly``
appends CSV files and rebuilds the weekly summary, ``ingest`` does so for files not loaded before. ``rankings`` brings the
rankings up to date with batches added to the access layer, ``vacuum`` deletes folders that no version needs.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from rentmill.plans.buckets import build_staging_in_buckets
from rentmill.plans.current import refresh_rankings
from rentmill.plans.layers import (
    Source, build_business, build_staging, land_tables, load_raw, quality_to_access, raw_to_quality,
)
from rentmill.plans.pipeline import run_pipeline
from rentmill.plans.weekly import APPENDED, append_and_summarise
from rentmill.schemas import LAYERS, SCHEMAS
from rentmill.session import build_session
from rentmill.sources import jdbc_source
from rentmill.streaming import ingest_new_files
from rentmill.streaming.ingest import ANY_AGE, INGESTED
from rentmill.versions import vacuum

STEPS = ("land", "load", "quality", "access", "staging", "business", "all", "weekly", "ingest", "rankings", "vacuum")
NEEDED = {"weekly": ("files",), "ingest": ("files", "checkpoint")}


def arguments(argv: Sequence[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="rentmill", description=__doc__)
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("--root", required=True, help="folder of the layers, shared by all executors")
    parser.add_argument("--landing", help="folder of the CSV exports (default: ROOT/landing)")
    parser.add_argument("--url", help="JDBC address of the source database (land, all)")
    parser.add_argument("--partitions", type=int, default=8, help="parallel reads per database table")
    parser.add_argument("--property", action="append", default=[], metavar="NAME=VALUE", help="JDBC property")
    parser.add_argument("--properties-file", help="file of NAME=VALUE lines, for what other users must not see")
    parser.add_argument("--upto", default="business", help="last layer of an all run")
    parser.add_argument("--source", default="staging", choices=("staging", "access"), help="input of business")
    parser.add_argument("--files", help="folder of rental CSV files (weekly, ingest)")
    parser.add_argument("--checkpoint", help="record of the files loaded so far (ingest)")
    parser.add_argument("--archive", help="folder that loaded files move to (ingest)")
    parser.add_argument("--table", help="raw table that weekly or ingest adds to; its summary is named after it")
    parser.add_argument("--max-file-age", default=ANY_AGE, help="how long ingest remembers file names (ingest)")
    parser.add_argument("--quarantine", action="store_true", help="set malformed lines aside instead of stopping (load)")
    parser.add_argument("--buckets", type=int, help="store facts in this many buckets or more and stage from them (staging)")
    parser.add_argument("--by-quantiles", action="store_true", help="split database scans at quantiles of the key (land, all)")
    parser.add_argument("--hours", type=float, default=24, help="age from which unneeded folders go (vacuum)")
    options = parser.parse_args(argv)
    for name in NEEDED.get(options.step, ()):
        if getattr(options, name) is None:
            parser.error(f"{options.step} needs --{name}")
    return options


def jdbc_properties(options: argparse.Namespace) -> dict[str, str]:
    lines = list(options.property)
    if options.properties_file:
        with open(options.properties_file) as file:
            lines += [line.strip() for line in file if line.strip() and not line.startswith("#")]
    return dict(line.split("=", 1) for line in lines)


def main(argv: Sequence[str], spark: SparkSession | None = None, source: Source | None = None) -> None:
    options = arguments(argv)
    spark = spark or build_session(f"rentmill-{options.step}")
    root, landing = options.root, options.landing or f"{options.root}/landing"
    if source is None and options.step in ("land", "all"):
        if options.url is None:
            raise SystemExit(f"{options.step} needs --url")
        source = jdbc_source(spark, options.url, partitions=options.partitions, by_quantiles=options.by_quantiles, properties=jdbc_properties(options))

    def ingest() -> None:
        query = ingest_new_files(
            spark, options.files, root, SCHEMAS["rental"], options.checkpoint, archive_dir=options.archive,
            table=options.table or INGESTED, max_file_age=options.max_file_age,
        )
        query.awaitTermination()

    steps = {
        "land": lambda: land_tables(spark, source, landing),
        "load": lambda: load_raw(spark, landing, root, quarantine=options.quarantine),
        "quality": lambda: raw_to_quality(spark, root),
        "access": lambda: quality_to_access(spark, root),
        "staging": lambda: build_staging_in_buckets(spark, root, options.buckets) if options.buckets else build_staging(spark, root),
        "business": lambda: build_business(spark, root, options.source),
        "all": lambda: run_pipeline(spark, source, root, options.upto).show(100, truncate=False),
        "weekly": lambda: append_and_summarise(spark, options.files, root, options.table or APPENDED),
        "ingest": ingest,
        "rankings": lambda: refresh_rankings(spark, root),
        "vacuum": lambda: vacuum(spark, root, LAYERS, options.hours * 3600),
    }
    steps[options.step]()


if __name__ == "__main__":
    main(sys.argv[1:])
