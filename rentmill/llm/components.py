"""Connected components of an edge table by alternating large and small stars, on tables in shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentmill.llm.tables import discard, stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every node of the edges ``(a, b)``.

    Each round points the neighbours of a node at the smallest of them, first the larger ones, then the smaller ones; the
    number of rounds grows with the logarithm of the longest path. Rounds are written tables. The minimum per node is a
    partial aggregation; the join that hands it out has plain shuffles on both sides, which adaptive execution splits
    at a node with very many neighbours.
    """
    links = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lows = stored(both.groupBy("a").agg(F.min("b").alias("low")), "lows")
        low = F.least("a", "low")
        large = both.join(lows, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), low.alias("b"))
        large = stored(large.distinct(), "links")
        discard(links, lows)
        lows = stored(large.groupBy("a").agg(F.min("b").alias("low")), "lows")
        small = large.join(lows, "a")
        links = stored(
            small.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(lows.select("a", F.col("low").alias("b"))).where("a <> b").distinct(),
            "links",
        )
        discard(large, lows)
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
