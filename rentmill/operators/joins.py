"""Facts joined along a chain of dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rentmill.operators.sizes import broadcast_bytes, planned_bytes


def join_through(facts: DataFrame, *chain: tuple[DataFrame, str], broadcast_limit: int | None = None) -> DataFrame:
    """``facts`` inner-joined to the first dimension, that to the second, and so on, each on its named column.

    Inner joins give the same rows in any order; the order decides what is shuffled. If every dimension is small
    enough to be broadcast, the facts meet them one by one and are not shuffled at all. Otherwise the
    dimensions are joined to each other first, so the facts are shuffled once, and rows that a dimension
    multiplies come out of the last join. ``broadcast_limit`` replaces the planner's own limit on what is small.
    """

    def small(dimension: DataFrame) -> bool:
        return planned_bytes(dimension) <= (broadcast_bytes(dimension) if broadcast_limit is None else broadcast_limit)

    if all(small(dimension) for dimension, _ in chain):
        for dimension, key in chain:
            facts = facts.join(dimension, key)
        return facts
    far, far_key = chain[-1]
    for dimension, key in reversed(chain[:-1]):
        far, far_key = dimension.join(far, far_key), key
    return facts.join(far, far_key)
