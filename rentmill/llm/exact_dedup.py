"""Exact deduplication: two passes of a Bloom filter leave only possible copies to be shuffled.

Texts are equal when they agree after all white space is removed; null counts as the empty text. Of equal
texts the row with the most code points stays, then the smallest doc_id (null last), then the row read first.

Pass one sets two cells of a counting filter per row and keeps the cells that were set at least twice. Pass two
probes that filter: a row with a cell of its own cannot have a copy and goes straight through; the others are
grouped by the SHA-256 of their normalised text. A false positive only sends a row through the shuffle, so the
size of the filter changes the cost and never the result.

The filter is broadcast as 64-bit words. It has 16 cells per row and hash, at most ``most_cells``; its
``2 * most_cells / 64`` words of 16 bytes bound the broadcast (64 MB at the default) whatever the input.
Groups are reduced by partial aggregation, so a text that owns a third of all rows is one row per map task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentmill.llm.tables import SPACE, stored, text_of

CELLS_PER_ROW = 16
MOST_CELLS = 1 << 27
HASHES = 2


def normalised_digest(text: str = "text") -> Column:
    """SHA-256 of the text without white space, as lowercase hex."""
    return F.sha2(F.regexp_replace(text_of(text), f"{SPACE}+", ""), 256)


def _cells(sha: str, cells: int) -> list[Column]:
    """One cell number per hash function, each function with a range of its own."""
    return [F.pmod(F.xxhash64(F.col(sha), F.lit(k)), F.lit(cells)) + k * cells for k in range(HASHES)]


def repeated_cells(digests: DataFrame, sha: str, rows: int, most_cells: int = MOST_CELLS) -> tuple[DataFrame, int]:
    """Words of the filter's cells that were set at least twice, and the number of cells per hash function."""
    cells = 64
    while cells < min(CELLS_PER_ROW * rows, most_cells):
        cells *= 2
    counted = digests.select(F.explode(F.array(*_cells(sha, cells))).alias("cell")).groupBy("cell").agg(
        F.count(F.lit(1)).alias("times")
    )
    bit = F.expr("shiftleft(1L, CAST(cell & 63 AS INT))")
    words = counted.where("times >= 2").groupBy(F.expr("shiftright(cell, 6)").alias("word"))
    return words.agg(F.bit_or(bit).alias("bits")), cells


def flag_possible_copies(rows: DataFrame, sha: str, words: DataFrame, cells: int, flag: str) -> DataFrame:
    """``rows`` with a column that is false where no other row can have the same digest."""
    hits = []
    for k, cell in enumerate(_cells(sha, cells)):
        word, bits, place = f"{flag}_word{k}", f"{flag}_bits{k}", f"{flag}_cell{k}"
        part = F.broadcast(words.select(F.col("word").alias(word), F.col("bits").alias(bits)))
        rows = rows.withColumn(place, cell).withColumn(word, F.shiftright(place, 6)).join(part, word, "left")
        hits.append(F.expr(f"coalesce({bits} & shiftleft(1L, CAST({place} & 63 AS INT)), 0L) != 0"))
    helpers = [f"{flag}_{kind}{k}" for kind in ("word", "bits", "cell") for k in range(HASHES)]
    return rows.withColumn(flag, reduce(lambda a, b: a & b, hits)).drop(*helpers)


def copy_groups(docs: DataFrame, *, most_cells: int = MOST_CELLS) -> DataFrame:
    """Every row of ``docs`` with the row that stays for its text.

    Columns: doc_id, keep_id, group_size, kept, text_sha256. Exactly one row of a group is kept, also where rows
    share a doc_id. Other columns of ``docs`` than doc_id and text are not read.
    """
    digests = stored(
        docs.select(
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            F.char_length(text_of()).alias("code_points"),
            normalised_digest().alias("text_sha256"),
        ),
        "digests",
    )
    words, cells = repeated_cells(digests, "text_sha256", digests.count(), most_cells)
    flagged = flag_possible_copies(digests, "text_sha256", stored(words, "filter"), cells, "maybe")
    alone = flagged.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256",
    )
    maybe = flagged.where("maybe").drop("maybe")
    order = F.struct(-F.col("code_points"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    groups = maybe.groupBy("text_sha256").agg(
        F.count(F.lit(1)).alias("group_size"), F.min(order).alias("best")
    )
    # Written, so that both sides of the join are plain shuffles, which adaptive execution splits at a hot text.
    groups = stored(groups.select("text_sha256", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row")), "groups")
    grouped = maybe.join(groups, "text_sha256").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256"
    )
    return alone.unionByName(grouped)


def drop_copies(docs: DataFrame, *, most_cells: int = MOST_CELLS) -> DataFrame:
    """``docs`` with one row per text, all columns kept; rows without a possible copy are not shuffled."""
    digests = stored(docs.select(normalised_digest().alias("sha")), "digests")
    words, cells = repeated_cells(digests, "sha", digests.count(), most_cells)
    words = stored(words, "filter")
    whole = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), normalised_digest().alias("sha"), F.monotonically_increasing_id().alias("place")
    )
    flagged = flag_possible_copies(whole, "sha", words, cells, "maybe")
    order = F.struct(
        -F.char_length(F.coalesce(F.col("row.text"), F.lit(""))), F.col("row.doc_id").isNull(), F.col("row.doc_id"), F.col("place")
    )
    stays = flagged.where("maybe").groupBy("sha").agg(F.min_by("row", order).alias("row"))
    return flagged.where(~F.col("maybe")).select("row.*").unionByName(stays.select("row.*"))
