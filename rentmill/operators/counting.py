"""Counting along a chain of joins without building the joined rows.

A ranking joins facts to ever coarser dimensions and counts at the end. Inner joins and counts commute: the
facts can be counted per key first and the counts carried through each join, summed again before the next.
Sums combine on the map side, so a key that owns a third of the facts costs one row per map task, and
every shuffle moves one row per key instead of one per fact.

Summing before a join is free where the join shuffles on that key anyway, and worth it where the join fans
out. Before a dimension small enough to be broadcast it would only add a shuffle, so there it is left out.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentmill.operators.sizes import broadcast_bytes, planned_bytes

COUNT, COPIES, SALT, HOT, PLACE = "_count", "_copies", "_salt", "_hot", "_place"

# A link table up to this size is joined as it is: even a third of it is one ordinary task's work.
PLAIN_JOIN_BYTES = 2 << 30
# A key with at least this many links is spread over several tasks. At most rows / HOT_LINKS keys can be that
# large, which bounds the broadcast list of them: 10^13 links give a million keys, tens of MB.
HOT_LINKS = 10_000_000


def join_counts(
    counts: DataFrame,
    links: DataFrame,
    key: str,
    *,
    links_bytes: int | None = None,
    plain_join_bytes: int = PLAIN_JOIN_BYTES,
    hot_links: int = HOT_LINKS,
) -> DataFrame:
    """``counts`` inner-joined to ``links``, a row's count repeated for each link.

    Counts arrive partitioned by key, which leaves adaptive execution no shuffle to split on that side. So in
    a large link table the keys with ``hot_links`` links or more are found (a pass over the key column alone) and get a
    salt per ``hot_links`` links; their few counts are repeated once per salt. All other keys join unsalted. Copies of a link are
    collapsed into one first, since copies cannot be told apart by a salt.

    Links are dealt out before they are collapsed or counted: the task that scans or makes them would hold all its links to combine them.
    """
    if (planned_bytes(links) if links_bytes is None else links_bytes) <= plain_join_bytes:
        return counts.join(links, key)
    carried = [c for c in links.columns if c != key]
    if not carried:
        pairs = links.groupBy(key).agg(F.count(F.lit(1)).alias(COPIES))
        return counts.join(pairs, key).select(key, (F.col(COUNT) * F.col(COPIES)).alias(COUNT))
    # By the place they come from too, so that many copies of one link are collapsed in several tasks first.
    links = links.withColumn(PLACE, F.spark_partition_id()).repartition(key, *carried, PLACE)
    pairs = links.groupBy(key, *carried).agg(F.count(F.lit(1)).alias(COPIES))
    # At most rows / hot_links keys; the planner broadcasts them if they are few, whatever the caller's hot_links.
    hot = links.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / hot_links).alias(HOT), F.count(F.lit(1)).alias(COUNT + HOT))
    hot = hot.where(F.col(COUNT + HOT) >= hot_links).drop(COUNT + HOT)
    is_hot = F.col(HOT).isNotNull()
    spread_pairs = pairs.join(hot, key, "left").withColumn(
        SALT, F.when(is_hot, F.pmod(F.xxhash64(*carried), F.col(HOT))).otherwise(0)
    )
    repeated_counts = counts.join(hot, key, "left").withColumn(
        SALT, F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(HOT), F.lit(1).cast("long")) - 1))
    )
    return (
        repeated_counts.drop(HOT)
        .join(spread_pairs.drop(HOT), [key, SALT])
        .select(*carried, (F.col(COUNT) * F.col(COPIES)).alias(COUNT))
    )


def counted_rows(fact: DataFrame, key: str, counted: str = "rental_id") -> DataFrame:
    """Every row of ``fact`` with its key, counting one if ``counted`` is not null and zero if it is."""
    return fact.select(key, F.col(counted).isNotNull().cast("long").alias(COUNT))


def sum_counts(counts: DataFrame, key: str) -> DataFrame:
    return counts.groupBy(key).agg(F.sum(COUNT).alias(COUNT))


def carry_counts(
    counts: DataFrame,
    key: str,
    tables: Mapping[str, DataFrame],
    hops: Sequence[tuple[str, str]],
    fan_out: Collection[str] = (),
    **join_settings: int,
) -> DataFrame:
    """The counts of ``key`` per value of the last hop's column.

    Each hop ``(table, column)`` joins on the column reached so far and moves on to ``column``. ``fan_out``
    names the tables that match many rows per key.
    """
    for table, column in hops:
        links = tables[table].select(*dict.fromkeys((key, column)))
        size = planned_bytes(links)
        if table in fan_out or size > broadcast_bytes(links):
            counts = sum_counts(counts, key)
        counts = join_counts(counts, links, key, links_bytes=size, **join_settings)
        key = column
    return sum_counts(counts, key)
