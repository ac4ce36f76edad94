"""

the matching ``oracle_sql()[name]``. Queries that store tables work in a fresh scratch folder and return what they
read back.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rentmill.fixtures import oracle
from rentmill.fixtures.tables import ShopTables
from rentmill.functions import register_functions, week_start
from rentmill.operators import preview, run_sql
from rentmill.plans.buckets import bucketed_tables, stage_in_buckets, store_buckets
from rentmill.plans.business import RANKINGS, rank, rank_directly
from rentmill.plans.current import add_batch, refresh_rankings
from rentmill.plans.layers import (
    QUALITY_RULES, build_business, build_staging, land_tables, layer_report, load_raw, project, promote,
    quality_to_access, raw_to_quality, store_tables,
)
from rentmill.plans.pipeline import run_pipeline
from rentmill.plans.staging import STAGES
from rentmill.plans.weekly import APPENDED, append_and_summarise, returned, summary_of, weekly_returned
from rentmill.schemas import ACCESS, BUSINESS, QUALITY, RAW, SCHEMAS, STAGING, TABLES
from rentmill.sinks import export_csv, query_to_layer, rejected_of, write_layer
from rentmill.sources import load_layer, read_csv_folder, read_layer
from rentmill.sources.csv import read_options, restore_empty
from rentmill.storage import scratch_folder
from rentmill.streaming import ingest_new_files, read_ingested, read_rejected
from rentmill.streaming.ingest import INGESTED

try:
    import corpus_pipeline
    from rentmill.llm import queries as llm
except ImportError as missing:  # the subpackage may be left out; any other failure is an error
    if missing.name not in ("rentmill.llm", "corpus_pipeline"):
        raise
    corpus_pipeline = llm = None

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_DIR = "/root/testdata/sf0.001"

RATING_SQL = """
    SELECT film.rating, count(*) AS rentals
    FROM rental
    JOIN inventory ON inventory.inventory_id = rental.inventory_id
    JOIN film ON film.film_id = inventory.film_id
    WHERE rental.return_date IS NOT NULL
    GROUP BY film.rating
"""
NESTED_SQL = """
    SELECT best.city, best.payments FROM (
        SELECT city.city, count(home.rental_id) AS payments
        FROM (
            SELECT paid.rental_id, address.city_id
            FROM (SELECT payment.rental_id, customer.address_id
                  FROM payment JOIN customer ON payment.customer_id = customer.customer_id) AS paid
            JOIN address ON paid.address_id = address.address_id
        ) AS home
        JOIN city ON home.city_id = city.city_id
        GROUP BY city.city
    ) AS best WHERE best.payments > 0
"""
WEEKLY_SQL = """
    SELECT week_start(rental_date) AS week, count(*) AS total
    FROM rental WHERE return_date IS NOT NULL GROUP BY 1
"""


# --- sources and sinks -----------------------------------------------------------------------------------------


def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{scratch_folder(spark, 'scan')}/rental"
    export_csv(ShopTables(spark, sf_dir)["rental"], folder)
    return read_csv_folder(spark, folder, SCHEMAS["rental"])


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, with their line breaks and quotes, to CSV and back."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{scratch_folder(spark, 'roundtrip')}/documents"
    export_csv(documents, folder)
    return read_csv_folder(spark, folder, documents.schema)


def scan_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_folder(spark, "layer")
    write_layer(ShopTables(spark, sf_dir)["inventory"], root, RAW, "inventory")
    return read_layer(spark, root, RAW, "inventory")


def write_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by a projection of itself."""
    root, payment = scratch_folder(spark, "overwrite"), ShopTables(spark, sf_dir)["payment"]
    write_layer(payment, root, RAW, "payment")
    write_layer(
        read_layer(spark, root, RAW, "payment").select("payment_id", "customer_id", "rental_id"), root, RAW, "payment"
    )
    return read_layer(spark, root, RAW, "payment")


def write_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, rental = scratch_folder(spark, "append"), ShopTables(spark, sf_dir)["rental"]
    for _ in range(2):
        write_layer(rental, root, RAW, "rental", mode="append")
    return read_layer(spark, root, RAW, "rental")


def append_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, each appended twice under its id."""
    root, rental = scratch_folder(spark, "once"), ShopTables(spark, sf_dir)["rental"]
    for number in (0, 1, 0, 1):
        rows = rental.where(F.col("rental_id") % 2 == number)
        write_layer(rows, root, RAW, "rental", mode="append", batches=[f"drop-{number}"])
    return read_layer(spark, root, RAW, "rental")


def query_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_folder(spark, "query")
    register_functions(spark)
    query_to_layer(spark, WEEKLY_SQL, root, BUSINESS, "weekly", {"rental": ShopTables(spark, sf_dir)["rental"]})
    return read_layer(spark, root, BUSINESS, "weekly")


# --- projections, filters, functions ---------------------------------------------------------------------------


def promote_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project("rental", ShopTables(spark, sf_dir)["rental"], QUALITY_RULES)


def promote_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project("address", ShopTables(spark, sf_dir)["address"], QUALITY_RULES)


def filter_returned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return returned(ShopTables(spark, sf_dir)["rental"])


def sql_surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, RATING_SQL, ShopTables(spark, sf_dir).all())


def sql_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joins written as subqueries three deep."""
    return run_sql(spark, NESTED_SQL, ShopTables(spark, sf_dir).all())


def week_trunc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ShopTables(spark, sf_dir)["rental"].select("rental_id", week_start("rental_date").alias("week"))


def count_nonnull(spark: SparkSession, sf_dir: str) -> DataFrame:
    payments = ShopTables(spark, sf_dir)["payment"].groupBy("customer_id")
    return payments.agg(F.count("rental_id").alias("matched"), F.count(F.lit(1)).alias("payments"))


def preview_top2(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest_first = ShopTables(spark, sf_dir)["payment"].select("payment_id", "customer_id").orderBy(F.desc("payment_id"))
    return preview(latest_first, 2)


# --- staging, rankings, weekly summary -------------------------------------------------------------------------


def _staged(target: str, **settings) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = STAGES[target](ShopTables(spark, sf_dir), **settings)
        return rows.withColumn("amount", F.col("amount").cast("double")) if "amount" in rows.columns else rows

    return query


def _ranked(target: str, **settings) -> Query:
    return lambda spark, sf_dir: rank_directly(target, ShopTables(spark, sf_dir), **settings)


# Settings that take the paths meant for large tables: link tables checked for hot keys, and nothing called small.
SALTED = {"plain_join_bytes": 0, "hot_links": 3}
SHUFFLED = {"broadcast_limit": -1}


def _ranked_from_stage(target: str) -> Query:
    return lambda spark, sf_dir: rank(target, STAGES[target](ShopTables(spark, sf_dir)))


def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekly_returned(ShopTables(spark, sf_dir)["rental"])


def _bucketed(target: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = _with_access(spark, sf_dir, "buckets")
        store_buckets(spark, root, number=8)
        return stage_in_buckets(target, bucketed_tables(spark, root))

    return query


# --- layers and pipelines --------------------------------------------------------------------------------------


def _source(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    return ShopTables(spark, sf_dir).__getitem__


def _with_raw(spark: SparkSession, sf_dir: str, label: str) -> str:
    """A fresh root whose raw layer is landed and loaded."""
    root = scratch_folder(spark, label)
    land_tables(spark, _source(spark, sf_dir), f"{root}/landing")
    load_raw(spark, f"{root}/landing", root)
    return root


def _with_access(spark: SparkSession, sf_dir: str, label: str) -> str:
    """A fresh root whose access layer is filled straight from the derived tables."""
    root, shop = scratch_folder(spark, label), ShopTables(spark, sf_dir)
    store_tables(spark, lambda table: project(table, shop[table], QUALITY_RULES), root, ACCESS)
    return root


def land_and_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layer_report(spark, _with_raw(spark, sf_dir, "land"), {RAW: TABLES})


def layer_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _with_raw(spark, sf_dir, "quality")
    raw_to_quality(spark, root)
    return layer_report(spark, root, {QUALITY: TABLES})


def layer_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _with_raw(spark, sf_dir, "access")
    raw_to_quality(spark, root)
    quality_to_access(spark, root)
    return layer_report(spark, root, {ACCESS: TABLES})


def _from_access(table: str) -> Query:
    """The stored rows of a table that was landed, loaded and promoted twice."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, source = scratch_folder(spark, "access"), _source(spark, sf_dir)
        land_tables(spark, source, f"{root}/landing", [table])
        load_raw(spark, f"{root}/landing", root, [table])
        promote(spark, root, RAW, QUALITY, QUALITY_RULES, [table])
        promote(spark, root, QUALITY, ACCESS, {}, [table])
        rows = read_layer(spark, root, ACCESS, table)
        money = [f.name for f in rows.schema.fields if f.dataType.typeName() == "decimal"]
        return rows.withColumns({name: F.col(name).cast("double") for name in money})

    return query


def land_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text array and bytes, as a database gives them, through CSV into the raw layer."""
    root, shop = scratch_folder(spark, "types"), ShopTables(spark, sf_dir)
    given = {
        "film": shop["film"].withColumn("special_features", F.expr("array(rating, 'a, b', NULL, '', 'plain')")),
        "staff": shop["staff"].withColumn("picture", F.encode("username", "UTF-8")).withColumn("email", F.lit("")),
    }
    land_tables(spark, given.__getitem__, f"{root}/landing", given)
    load_raw(spark, f"{root}/landing", root, given)
    film, staff = (read_layer(spark, root, RAW, table) for table in given)
    return film.select(F.lit("film").alias("of"), F.col("film_id").alias("id"), F.col("special_features").alias("text"), F.lit(None).cast("string").alias("email")).unionAll(
        staff.select(F.lit("staff"), "staff_id", "picture", "email")
    )


def layer_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stored rows of two staging tables, and the number of rows of all six."""
    root = _with_access(spark, sf_dir, "staging")
    build_staging(spark, root)
    customer, store = (read_layer(spark, root, STAGING, t) for t in ("Top_Customer", "Top_Store"))
    report = layer_report(spark, root, {STAGING: tuple(STAGES)})
    return customer.select(
        F.lit("Top_Customer").alias("stage"), "last_name", "store_id", "rental_id", F.col("amount").cast("double").alias("amount")
    ).unionAll(
        store.select(F.lit("Top_Store"), F.lit(None), "store_id", "rental_id", F.lit(None))
    ).unionAll(report.select(F.lit("rows"), "table", F.lit(None), "rows", F.lit(None)))


def _business_rows(spark: SparkSession, root: str) -> DataFrame:
    """All six stored rankings in one shape, so the check sees every value."""
    rankings = load_layer(spark, root, BUSINESS, RANKINGS)
    return _union(
        df.select(
            F.lit(target).alias("ranking"),
            F.col(RANKINGS[target].name).cast("string").alias("name"),
            F.col("Total_Rental").alias("total_rental"),
        )
        for target, df in rankings.items()
    )


def _union(parts) -> DataFrame:
    whole = None
    for part in parts:
        whole = part if whole is None else whole.unionAll(part)
    return whole


def layer_business(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _with_access(spark, sf_dir, "business")
    build_staging(spark, root)
    build_business(spark, root)
    return _business_rows(spark, root)


def layer_business_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _with_access(spark, sf_dir, "business")
    build_business(spark, root, source=ACCESS)
    return _business_rows(spark, root)


def layers_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_pipeline(spark, _source(spark, sf_dir), scratch_folder(spark, "pipeline"))


def layers_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table that a whole run stored, with its rows and the sum of 48-bit digests of their values as text."""
    root = scratch_folder(spark, "values")
    run_pipeline(spark, _source(spark, sf_dir), root)
    contents = {RAW: TABLES, QUALITY: TABLES, ACCESS: TABLES, STAGING: tuple(STAGES), BUSINESS: tuple(RANKINGS)}
    parts = []
    for layer, tables in contents.items():
        for table, rows in load_layer(spark, root, layer, tables).items():
            values = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in rows.columns))
            digests = rows.select(F.conv(F.substring(F.md5(values), 1, 12), 16, 10).cast("long").alias("digest"))
            parts.append(digests.agg(F.count(F.lit(1)).alias("rows"), _sum_of_48_bits("digest").cast("string").alias("checksum")).select(
                F.lit(layer).alias("layer"), F.lit(table).alias("table"), "rows", "checksum"
            ))
    return _union(parts)


def _sum_of_48_bits(column: str) -> Column:
    """The sum of a long column of 48-bit numbers, 0 of none: summed as longs by halves, which hold 2^39 rows, since a sum of decimals takes most of the time."""
    high, low = F.sum(F.shiftright(column, 24)), F.sum(F.col(column).bitwiseAND(F.lit((1 << 24) - 1)))
    return F.coalesce(high.cast("decimal(20,0)") * F.lit(1 << 24) + low, F.lit(0))


def layers_to_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_pipeline(spark, _source(spark, sf_dir), scratch_folder(spark, "pipeline"), upto=ACCESS)


def rankings_after_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six rankings, kept current over three batches of rentals and payments."""
    facts = {"rental": "rental_id", "payment": "payment_id"}
    root, shop = scratch_folder(spark, "batches"), ShopTables(spark, sf_dir)
    store_tables(spark, lambda table: project(table, shop[table], QUALITY_RULES), root, ACCESS, [t for t in TABLES if t not in facts])
    for number in range(3):
        for fact, key in facts.items():
            add_batch(shop[fact].where(F.col(key) % 3 == number), root, fact, f"batch-{number}")
        refresh_rankings(spark, root)
    return _business_rows(spark, root)


def load_with_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rentals by staff, loaded from files whose staff is a word in every seventh rental, and the lines that were set aside."""
    root, rental = scratch_folder(spark, "bad-lines"), ShopTables(spark, sf_dir)["rental"]
    staff = F.when(F.col("rental_id") % 7 == 0, F.lit("nobody")).otherwise(F.col("staff_id").cast("string"))
    export_csv(rental.withColumn("staff_id", staff), f"{root}/landing/rental")
    load_raw(spark, f"{root}/landing", root, ["rental"], quarantine=True)
    return _loaded_and_rejected(read_layer(spark, root, RAW, "rental"), read_layer(spark, root, RAW, rejected_of("rental")))


def _loaded_and_rejected(loaded: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rentals by place and copy; of a rejected line, its first and third field."""
    fields = F.split("line", ",")
    return loaded.select(F.lit("loaded").alias("place"), "rental_id", "inventory_id").unionAll(
        rejected.select(F.lit("rejected"), fields[0].cast("long"), fields[2].cast("long"))
    )


def append_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_folder(spark, "weekly")
    export_csv(ShopTables(spark, sf_dir)["rental"], f"{root}/landing/rental")
    append_and_summarise(spark, f"{root}/landing/rental", root)
    return append_and_summarise(spark, f"{root}/landing/rental", root)


# --- streaming -------------------------------------------------------------------------------------------------


def _ingested(spark: SparkSession, sf_dir: str, label: str, **settings) -> str:
    """A root into which all rentals were ingested, with a second run that finds nothing new."""
    root = scratch_folder(spark, label)
    export_csv(ShopTables(spark, sf_dir)["rental"], f"{root}/landing/rental")
    for _ in range(2):
        run = ingest_new_files(
            spark, f"{root}/landing/rental", root, SCHEMAS["rental"], f"{root}/checkpoint", **settings
        )
        run.awaitTermination()
    return root


def ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_ingested(spark, _ingested(spark, sf_dir, "ingest", summarise=False))


def ingest_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_layer(spark, _ingested(spark, sf_dir, "ingest"), BUSINESS, summary_of(INGESTED))


def _in_drops(spark: SparkSession, sf_dir: str, root: str, settings: list[dict]) -> None:
    """All rentals in as many drops as there are settings, an ingest run with them after each."""
    rental = ShopTables(spark, sf_dir)["rental"]
    for number, own in enumerate(settings):
        export_csv(rental.where(F.col("rental_id") % len(settings) == number), f"{root}/drops/{number}")
        run = ingest_new_files(spark, f"{root}/drops/*", root, SCHEMAS["rental"], f"{root}/checkpoint", **own)
        run.awaitTermination()


def ingest_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rentals by where their file is after three drops: a file moves in the run after the one that loaded it."""
    root = scratch_folder(spark, "archive")
    _in_drops(spark, sf_dir, root, [{"archive_dir": f"{root}/loaded"}] * 3)

    def rows(place: str, folder: str) -> DataFrame:
        reader = spark.read.schema(SCHEMAS["rental"]).options(**read_options(SCHEMAS["rental"]), recursiveFileLookup=True)
        return restore_empty(reader.csv(folder)).select(F.lit(place).alias("place"), "rental_id", "inventory_id")

    return rows("archive", f"{root}/loaded").unionAll(rows("folder", f"{root}/drops"))


def ingest_with_bad_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three drops, of which the second has malformed lines: they are listed, everything else is loaded."""
    root, rental = scratch_folder(spark, "bad-file"), ShopTables(spark, sf_dir)["rental"]
    for number in range(3):
        rows = rental.where(F.col("rental_id") % 3 == number)
        if number == 1:
            bad = F.when(F.col("rental_id") % 5 == 0, F.lit("not a number")).otherwise(F.col("staff_id").cast("string"))
            rows = rows.withColumn("staff_id", bad)
        export_csv(rows, f"{root}/drops/{number}")
        run = ingest_new_files(spark, f"{root}/drops/*", root, SCHEMAS["rental"], f"{root}/checkpoint")
        run.awaitTermination()
    return _loaded_and_rejected(read_ingested(spark, root), read_rejected(spark, root))


def ingest_summary_catches_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary after a run without one and a run with one."""
    root = scratch_folder(spark, "late-summary")
    _in_drops(spark, sf_dir, root, [{"summarise": False}, {"summarise": True}])
    return read_layer(spark, root, BUSINESS, summary_of(INGESTED))


def ingest_two_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summaries of two tables that are ingested side by side: all rentals, by rental date and by return date."""
    root, rental = scratch_folder(spark, "two"), ShopTables(spark, sf_dir)["rental"]
    parts = {"one": rental, "two": rental.withColumn("rental_date", F.col("return_date"))}
    for table, rows in parts.items():
        export_csv(rows, f"{root}/landing/{table}")
        run = ingest_new_files(spark, f"{root}/landing/{table}", root, SCHEMAS["rental"], f"{root}/checkpoint-{table}", table=table)
        run.awaitTermination()
    return _union(
        read_layer(spark, root, BUSINESS, summary_of(table)).select(F.lit(table).alias("table"), "week", "total") for table in parts
    )


def weekly_beside_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An append beside the main pipeline: the summary, and the rentals that the next promotion finds."""
    root, rental = scratch_folder(spark, "beside"), ShopTables(spark, sf_dir)["rental"]
    export_csv(rental, f"{root}/landing/rental")
    load_raw(spark, f"{root}/landing", root, ["rental"])
    append_and_summarise(spark, f"{root}/landing/rental", root)
    promote(spark, root, RAW, QUALITY, QUALITY_RULES, ["rental"])
    promoted = read_layer(spark, root, QUALITY, "rental").agg(F.count(F.lit(1)).alias("total"))
    summary = read_layer(spark, root, BUSINESS, summary_of(APPENDED))
    return summary.select(F.lit("summary").alias("of"), "week", "total").unionAll(
        promoted.select(F.lit("promoted"), F.lit(None).cast("date"), "total")
    )


# --- contract --------------------------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Rentals per actor's last name, on the smallest data."""
    return rank_directly("Top_Actor", ShopTables(spark, SMOKE_DIR))


def queries() -> dict[str, Query]:
    named = shop_queries() | (llm.QUERIES | {"pipeline": corpus_pipeline.run} if llm else {})
    return {name: _with_scratch(query) for name, query in named.items()}


def oracle_sql() -> dict[str, str]:
    return shop_sql() | (llm.SQL if llm else {})


def _with_scratch(query: Query) -> Query:
    """``query`` with a folder for scratch tables, on this machine only where the session is local and names none."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        context = spark.sparkContext
        named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
        if not named and context.master.startswith("local") and "cluster" not in context.master:
            context.setCheckpointDir(tempfile.mkdtemp(prefix="rentmill-"))
        return query(spark, sf_dir)

    return run


def shop_queries() -> dict[str, Query]:
    named: dict[str, Query] = {target.lower(): _ranked(target) for target in RANKINGS}
    named |= {f"{target.lower()}_from_stage": _ranked_from_stage(target) for target in RANKINGS}
    named |= {f"stage_{target.lower()}": _staged(target) for target in STAGES}
    named |= {f"stage_{t.lower()}_shuffled": _staged(t, **SHUFFLED) for t in ("Top_Actor", "Top_City")}
    named |= {f"{t.lower()}_salted": _ranked(t, **SALTED) for t in ("Top_Actor", "Top_Category")}
    named |= {f"stage_{t.lower()}_bucketed": _bucketed(t) for t in ("Top_Actor", "Top_Category")}
    named |= {f"access_{table}": _from_access(table) for table in ("film", "address", "staff")}
    named["weekly_returned"] = weekly
    plain = (
        scan_csv, csv_roundtrip, scan_layer, write_overwrite, write_append, query_to_table, promote_identity,
        promote_address, filter_returned, sql_surface, week_trunc, count_nonnull, preview_top2, land_and_load,
        layer_quality, layer_access, layer_staging, layer_business, layer_business_direct, layers_end_to_end,
        layers_to_access, append_weekly, ingest_incremental, ingest_weekly, ingest_archive, ingest_two_tables,
        ingest_summary_catches_up, weekly_beside_pipeline, land_types, sql_nested,
        append_once, layers_by_value, rankings_after_batches, load_with_bad_lines, ingest_with_bad_file,
    )
    return named | {query.__name__: query for query in plain}


def shop_sql() -> dict[str, str]:
    sql = {target.lower(): oracle.ranking(target) for target in RANKINGS}
    sql |= {f"{target.lower()}_from_stage": oracle.ranking(target) for target in RANKINGS}
    sql |= {f"stage_{target.lower()}": oracle.stage(target) for target in STAGES}
    sql |= {f"stage_{t.lower()}_shuffled": oracle.stage(t) for t in ("Top_Actor", "Top_City")}
    sql |= {f"stage_{t.lower()}_bucketed": oracle.stage(t) for t in ("Top_Actor", "Top_Category")}
    sql |= {f"{t.lower()}_salted": oracle.ranking(t) for t in ("Top_Actor", "Top_Category")}
    rentals, weekly_counts = oracle.whole_table("rental"), oracle.over_shop(oracle.WEEKLY)
    business = oracle.over_shop(
        "\nUNION ALL\n".join(
            f"SELECT '{target}' AS ranking, CAST({key} AS VARCHAR) AS name, count(rental_id) AS total_rental "
            f"FROM ({oracle.STAGED[target]}) AS s GROUP BY 2"
            for target, (key, _) in oracle.RANKED.items()
        )
    )
    return sql | {
        "weekly_returned": weekly_counts,
        "scan_csv": rentals,
        "csv_roundtrip": "SELECT doc_id, text, lang, source, n_chars FROM documents",
        "scan_layer": oracle.whole_table("inventory"),
        "write_overwrite": oracle.over_shop("SELECT payment_id, customer_id, rental_id FROM f_payment"),
        "write_append": oracle.over_shop("SELECT * FROM f_rental UNION ALL SELECT * FROM f_rental"),
        "append_once": rentals,
        "layers_by_value": oracle.values({"address": ("address2",)}),
        "rankings_after_batches": business,
        "load_with_bad_lines": oracle.over_shop(
            "SELECT CASE WHEN rental_id % 7 = 0 THEN 'rejected' ELSE 'loaded' END AS place, rental_id, inventory_id FROM f_rental"
        ),
        "ingest_with_bad_file": oracle.over_shop(
            "SELECT CASE WHEN rental_id % 15 = 10 THEN 'rejected' ELSE 'loaded' END AS place, rental_id, inventory_id FROM f_rental"
        ),
        "query_to_table": weekly_counts,
        "promote_identity": rentals,
        "promote_address": oracle.over_shop(
            "SELECT address_id, address, district, city_id, postal_code, phone, last_update FROM f_address"
        ),
        "filter_returned": oracle.over_shop("SELECT * FROM f_rental WHERE return_date IS NOT NULL"),
        "sql_surface": oracle.over_shop(
            "SELECT f.rating, count(*) AS rentals "
            "FROM f_rental AS r, f_inventory AS i, f_film AS f WHERE r.inventory_id = i.inventory_id "
            "AND i.film_id = f.film_id AND r.return_date IS NOT NULL GROUP BY f.rating"
        ),
        "week_trunc": oracle.over_shop(f"SELECT rental_id, {oracle.WEEK} AS week FROM f_rental"),
        "count_nonnull": oracle.over_shop(
            "SELECT customer_id, count(rental_id) AS matched, count(*) AS payments FROM f_payment GROUP BY customer_id"
        ),
        "preview_top2": oracle.over_shop(
            "SELECT payment_id, customer_id FROM f_payment ORDER BY payment_id DESC LIMIT 2"
        ),
        "land_and_load": oracle.report((RAW,)),
        "layer_quality": oracle.report((QUALITY,)),
        "layer_access": oracle.report((ACCESS,)),
        "layer_staging": oracle.over_shop(
            "SELECT 'Top_Customer' AS stage, last_name, store_id, rental_id, CAST(amount AS DOUBLE) AS amount "
            f"FROM ({oracle.STAGED['Top_Customer']}) AS a "
            f"UNION ALL SELECT 'Top_Store', NULL, store_id, rental_id, NULL FROM ({oracle.STAGED['Top_Store']}) AS b "
            + " ".join(
                f"UNION ALL SELECT 'rows', '{target}', NULL, count(*), NULL FROM ({oracle.STAGED[target]}) AS c"
                for target in STAGES
            )
        ),
        "access_film": oracle.over_shop(
            "SELECT * REPLACE (CAST(rental_rate AS DOUBLE) AS rental_rate, CAST(replacement_cost AS DOUBLE) AS replacement_cost) "
            "FROM f_film"
        ),
        "access_address": oracle.over_shop("SELECT * EXCLUDE (address2) FROM f_address"),
        "access_staff": oracle.whole_table("staff"),
        "land_types": oracle.over_shop(
            """SELECT 'film' AS of, film_id AS id, '{' || rating || ',"a, b",NULL,"",plain}' AS text, NULL AS email """
            r"FROM f_film UNION ALL SELECT 'staff', staff_id, '\x' || lower(hex(username)), '' FROM f_staff"
        ),
        "sql_nested": oracle.over_shop(
            "SELECT c.city, count(p.rental_id) AS payments FROM f_payment AS p, f_customer AS k, f_address AS a, f_city AS c "
            "WHERE p.customer_id = k.customer_id AND k.address_id = a.address_id AND a.city_id = c.city_id "
            "GROUP BY c.city HAVING count(p.rental_id) > 0"
        ),
        "layer_business": business,
        "layer_business_direct": business,
        "layers_end_to_end": oracle.report((RAW, QUALITY, ACCESS, STAGING, BUSINESS)),
        "layers_to_access": oracle.report((RAW, QUALITY, ACCESS)),
        "append_weekly": oracle.over_shop(
            f"SELECT week, 2 * total AS total FROM ({oracle.WEEKLY}) AS w"
        ),
        "ingest_incremental": rentals,
        "ingest_weekly": weekly_counts,
        "ingest_archive": oracle.over_shop(
            "SELECT CASE WHEN rental_id % 3 < 2 THEN 'archive' ELSE 'folder' END AS place, rental_id, inventory_id FROM f_rental"
        ),
        "ingest_summary_catches_up": weekly_counts,
        "ingest_two_tables": oracle.over_shop(
            f"SELECT 'one' AS \"table\", week, total FROM ({oracle.WEEKLY}) AS a UNION ALL SELECT 'two', week, total FROM "
            f"({oracle.WEEKLY.replace('FROM f_rental', 'FROM (SELECT * REPLACE (return_date AS rental_date) FROM f_rental) AS f')}) AS b"
        ),
        "weekly_beside_pipeline": oracle.over_shop(
            f"SELECT 'summary' AS of, week, total FROM ({oracle.WEEKLY}) AS a "
            "UNION ALL SELECT 'promoted', NULL, count(*) FROM f_rental"
        ),
    }
