"""A Bloom filter of wanted keys, so that a join moves only rows that may match and leaves the others where they are."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentmill.llm.tables import stored

CELLS_PER_KEY = 16
MOST_CELLS = 1 << 27
HASHES = 2


def _cells(key: str, cells: int) -> list[Column]:
    """One cell number per hash function, each function with a range of its own."""
    return [F.pmod(F.xxhash64(F.col(key), F.lit(f"cell {k}")), F.lit(cells)) + k * cells for k in range(HASHES)]


def flag_wanted(rows: DataFrame, key: str, wanted: DataFrame, flag: str, most_cells: int = MOST_CELLS) -> DataFrame:
    """``rows`` with a column ``flag`` that is true wherever ``key`` is among the stored keys of ``wanted``, and seldom elsewhere.

    ``wanted`` has the one column ``key``. The filter is broadcast as 64-bit words: ``CELLS_PER_KEY`` cells per key and hash, at most ``most_cells``,
    so ``2 * most_cells / 64`` words of 16 bytes bound it (64 MB at the default) whatever the input; beyond the keys it serves,
    more rows are flagged and nothing else changes.
    """
    number, cells = wanted.count(), 64
    while cells < min(CELLS_PER_KEY * number, most_cells):
        cells *= 2
    bit = F.expr("shiftleft(1L, CAST(cell & 63 AS INT))")
    words = wanted.select(F.explode(F.array(*_cells(key, cells))).alias("cell")).groupBy(F.expr("shiftright(cell, 6)").alias("word"))
    words = stored(words.agg(F.bit_or(bit).alias("bits")), "filter")
    hits = []
    for k, cell in enumerate(_cells(key, cells)):
        word, bits, place = f"{flag}_word{k}", f"{flag}_bits{k}", f"{flag}_cell{k}"
        part = F.broadcast(words.select(F.col("word").alias(word), F.col("bits").alias(bits)))
        rows = rows.withColumn(place, cell).withColumn(word, F.shiftright(place, 6)).join(part, word, "left")
        hits.append(F.expr(f"coalesce({bits} & shiftleft(1L, CAST({place} & 63 AS INT)), 0L) != 0"))
    helpers = [f"{flag}_{kind}{k}" for kind in ("word", "bits", "cell") for k in range(HASHES)]
    return rows.withColumn(flag, reduce(lambda a, b: a & b, hits)).drop(*helpers)
