"""Nearest neighbours by a block matrix join: int8 tiles with error bounds, survivors recomputed in double precision.

Vectors are quantised to int8 with a scale per vector, and the length of what quantising lost is kept. For a tile of
queries and candidates one matrix product of the int8 codes gives all distances between the quantised vectors; a true
distance differs from it by at most the two lost lengths. A pair can be among the k nearest only if its lower bound is
not above the k-th smallest upper bound (or the k-th distance found so far), so only such pairs are recomputed on the
original vectors. The result is exact. Every task keeps a heap of k per query over its tiles, and the heaps are merged.

Queries are blocks that are sent to every group of candidate blocks: a fixed query set against all rows, in blocks.
Within a candidate block identical vectors keep the ``k + 1`` smallest distinct ids and ``k + 1`` rows of each, since no more of them
can be in a result, one id being the query's own.

Vectors that are null, empty, all zero, or hold a null or non-finite component take no part, nor do rows with a null id.
Vectors of different dimensions do not meet. Rows that share a query's id are its own; a query id with several vectors
uses the smallest vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rentmill.llm.tables import stored

CANDIDATE_ROWS = 4096
QUERY_ROWS = 1024
BLOCKS_PER_GROUP = 16
MOST_PAIRS = 1 << 17
MOST_HEAPS = 256
BLOCK = "dimension int, block long, ids binary, vectors binary, codes binary, scales binary, lost binary"


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col(key).isNotNull() & (F.size(vector) > 0) & sound & F.exists(vector, lambda x: x != 0)).select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")
    )


def _quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    scales = np.abs(vectors).max(axis=1) / 127
    codes = np.rint(vectors / np.maximum(scales, np.finfo(float).tiny)[:, None]).astype(np.int8)
    return codes, scales, np.linalg.norm(vectors - codes * scales[:, None], axis=1)


def to_blocks(vectors: DataFrame, rows: int, copies: int | None = None) -> DataFrame:
    """Blocks of up to ``rows`` vectors of one dimension; of identical vectors the ``copies`` smallest ids, with as many rows of each."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                sizes = pc.list_value_length(part.column("vector")).to_numpy()
                for size in np.unique(sizes):
                    own = part.filter(pa.array(sizes == size))
                    ids = own.column("id").to_numpy()
                    flat = np.ascontiguousarray(own.column("vector").flatten().to_numpy().reshape(len(ids), size)) + 0.0
                    if copies is not None:
                        _, same = np.unique(flat.view(f"V{8 * size}").ravel(), return_inverse=True)
                        order = np.lexsort((ids, same))
                        other = np.r_[True, np.diff(same[order]) != 0]
                        new = other | np.r_[True, np.diff(ids[order]) != 0]
                        number = np.cumsum(new) - 1  # of the vector and id
                        of_vector = number - np.maximum.accumulate(np.where(other, number, 0))
                        row_of_id = np.arange(len(order)) - np.flatnonzero(new)[number]
                        kept = np.sort(order[(of_vector < copies) & (row_of_id < copies)])
                        ids, flat = ids[kept], flat[kept]
                    codes, scales, lost = _quantised(flat)
                    columns = [x.tobytes() for x in (ids, flat, codes, scales, lost)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([size], pa.int32()), pa.array([int(ids[0])], pa.int64()), *(pa.array([c], pa.binary()) for c in columns)],
                        ["dimension", "block", "ids", "vectors", "codes", "scales", "lost"],
                    )

    return vectors.select("id", "vector").mapInArrow(gather, BLOCK)


def _opened(row: dict, prefix: str) -> tuple[np.ndarray, ...]:
    size = row["dimension"]
    ids, vectors, codes, scales, lost = (
        np.frombuffer(row[f"{prefix}{name}"], kind)
        for name, kind in (("ids", np.int64), ("vectors", float), ("codes", np.int8), ("scales", float), ("lost", float))
    )
    return ids, vectors.reshape(-1, size), codes.reshape(-1, size), scales, lost


def _distances(queries: np.ndarray, candidates: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Distances of chosen pairs, summed one dimension after the other."""
    found = np.zeros(len(i))
    for at in range(0, len(i), MOST_PAIRS):
        a, b, total = i[at : at + MOST_PAIRS], j[at : at + MOST_PAIRS], 0.0
        for d in range(queries.shape[1]):
            gap = queries[a, d] - candidates[b, d]
            total = total + gap * gap
        found[at : at + MOST_PAIRS] = np.sqrt(total)
    return found


def _merged(heap, i, ids, distances, queries: int, k: int):
    """The k nearest per query of a heap and new pairs, by distance and then id."""
    i, ids, distances = (np.concatenate(x) for x in zip(heap, (i, ids, distances)))
    order = np.lexsort((ids, distances, i))
    i, ids, distances = i[order], ids[order], distances[order]
    place = np.arange(len(i)) - np.searchsorted(i, i)
    kept = place < k
    return i[kept], ids[kept], distances[kept]


def _tile(query: tuple, candidate: tuple, heap, k: int):
    q_ids, q, q_codes, q_scales, q_lost = query
    c_ids, c, c_codes, c_scales, c_lost = candidate
    exact = np.float32 if q.shape[1] * 127 * 127 < 1 << 24 else np.float64
    product = (q_codes.astype(exact) @ c_codes.astype(exact).T).astype(float)
    q_square = (q_codes.astype(float) ** 2).sum(axis=1) * q_scales**2
    c_square = (c_codes.astype(float) ** 2).sum(axis=1) * c_scales**2
    square = q_square[:, None] + c_square[None, :]
    near = np.sqrt(np.maximum(square - 2 * product * (q_scales[:, None] * c_scales[None, :]), 0))
    # Rounding of the sums above, far below the quantisation error, widens the bounds a little.
    slack = q_lost[:, None] + c_lost[None, :] + 1e-7 * np.sqrt(square)
    own = q_ids[:, None] == c_ids[None, :]
    upper = np.where(own, np.inf, near + slack)
    limit = np.full(len(q_ids), np.inf)
    if upper.shape[1] >= k:
        limit = np.partition(upper, k - 1, axis=1)[:, k - 1]
    full = np.bincount(heap[0], minlength=len(q_ids)) >= k
    worst = np.full(len(q_ids), -np.inf)
    np.maximum.at(worst, heap[0], heap[2])
    limit = np.where(full, np.minimum(limit, worst), limit)
    i, j = np.nonzero((near - slack <= limit[:, None]) & ~own)
    return _merged(heap, i, c_ids[j], _distances(q, c, i, j), len(q_ids), k)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, *, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of the k nearest rows of ``vectors`` to every query row."""
    asked = usable(queries, key, vector).groupBy("id").agg(F.min("vector").alias("vector"))
    blocks = stored(to_blocks(usable(vectors, key, vector), CANDIDATE_ROWS, k + 1), "candidates")
    groups = max(1, -(-blocks.count() // BLOCKS_PER_GROUP))
    query_blocks = to_blocks(asked, QUERY_ROWS).select(
        "dimension", *(F.col(c).alias(f"q_{c}") for c in ("block", "ids", "vectors", "codes", "scales", "lost")),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
    )
    grouped = blocks.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int"))
    tiles = query_blocks.join(grouped, ["dimension", "group"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[tuple, tuple] = {}

        def emptied(keys) -> Iterator[pa.RecordBatch]:
            for ids, heap in [heaps.pop(x) for x in keys]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[heap[0]]), pa.array(heap[1]), pa.array(heap[2])], ["query_id", "vec_id", "score"]
                )

        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
                query, name = _opened(row, "q_"), (row["dimension"], row["q_block"])
                empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
                _, heap = heaps.pop(name, (None, empty))
                heaps[name] = (query[0], _tile(query, _opened(row, ""), heap, k))
                if len(heaps) > MOST_HEAPS:
                    yield from emptied([next(iter(heaps))])
        yield from emptied(list(heaps))

    found = tiles.mapInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
