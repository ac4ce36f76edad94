"""Packing tokenised documents into sequences of one length by cutting-stock patterns.

A document's ids and a closing id are cut into full sequences and a rest; a rest of more than half a sequence is cut at
half, since lengths up to half combine with hardly any padding where longer ones leave gaps. Rests are counted by length, in units of
``UNIT`` tokens, and the histogram (at most ``sequence / UNIT`` rows) goes to the driver, where column generation
finds patterns: which lengths share a sequence and how many such sequences there are. Back in tasks, every piece has a
rank within its length: a running number within its task, from the scan, plus the pieces of earlier tasks. The rank picks
the pattern, the sequence and the place. No task sorts or sees all pieces of a length.

Tokenising is done once; pieces are written with their checksum (and ids on request), so later steps never see text. Ids are
those of the tokenizer file; a faster encoder of the same vocabulary is used, except for texts that hold a
special token's string. Null texts are empty and give the closing id alone; an empty table gives no pieces. Rows with one
doc_id are documents of their own.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rentmill.llm.blocks import text_blocks
from rentmill.llm.cutting_stock import whole_patterns
from rentmill.llm.tables import small_batches, stored
from rentmill.operators.views import passed_to

SEQUENCE = 1024
UNIT = 4
CLOSING_ID = 0
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SPECIAL = "<|endoftext|>"
PIECE_ROWS = 1 << 15


@lru_cache(maxsize=2)
def _rank_encoder(ranks: str):
    import tiktoken

    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})


@lru_cache(maxsize=2)
def _file_encoder(tokenizer: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer)


def encode(text: str, tokenizer: str = TOKENIZER, ranks: str | None = RANKS) -> list[int]:
    """The ids of the tokenizer file. ``ranks`` is the same vocabulary for the faster encoder, or None."""
    if ranks is None or SPECIAL in text:
        return _file_encoder(tokenizer).encode(text, add_special_tokens=False).ids
    return _rank_encoder(ranks).encode_ordinary(text)


def cut_pieces(
    docs: DataFrame, sequence: int = SEQUENCE, *, ids: bool = False, tokenizer: str = TOKENIZER, ranks: str | None = RANKS
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of every piece, its length in units, and its running number.

    ``task`` and ``number`` (within the task and length) are stable only once the result is written.
    """
    kinds = [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
             ("units", pa.int32()), ("task", pa.int32()), ("number", pa.int64())]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(sequence // UNIT + 1, np.int64)

        def batch(rows: list[tuple], owners: pa.Array, at: list[int], held: list[np.ndarray]) -> pa.RecordBatch:
            columns = [pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(kinds)]
            arrays, names = [owners.take(pa.array(at, pa.int64())), *columns], ["doc_id", *(n for n, _ in kinds)]
            if ids:
                arrays, names = [*arrays, pa.array(held, pa.list_(pa.int32()))], [*names, "ids"]
            return pa.RecordBatch.from_arrays(arrays, names)

        for block in text_blocks(batches):
            rows, at, held, owners = [], [], [], block.column("doc_id")
            for k, text in enumerate(pc.fill_null(block.column("text"), "").to_pylist()):
                found = np.array([*encode(text, tokenizer, ranks), CLOSING_ID], "<u4")
                starts = list(range(0, len(found), sequence))
                if sequence // 2 < len(found) - starts[-1] < sequence:
                    starts.append(starts[-1] + sequence // 2)
                for start, stop in zip(starts, [*starts[1:], len(found)]):
                    piece = found[start:stop]
                    units = -(-len(piece) // UNIT)
                    rows.append((start, len(piece), zlib.crc32(piece.tobytes()), len(found), units, task, int(seen[units])))
                    seen[units] += 1
                    at.append(k)
                    held.append(piece.astype(np.int32)) if ids else None
                    if len(rows) >= PIECE_ROWS:
                        yield batch(rows, owners, at, held)
                        rows, at, held = [], [], []
            if rows:
                yield batch(rows, owners, at, held)

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, units int, task int, number long"
    return docs.select("doc_id", "text").mapInArrow(cut, schema + (", ids array<int>" if ids else ""))


def _slots(units: np.ndarray, patterns: list[tuple[np.ndarray, int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: where each pattern's share of the ranks begins, pieces per sequence, first sequence."""
    slots = {int(u): ([], [], []) for u in units}
    rank, first = np.zeros(len(units), np.int64), 0
    for pattern, times in patterns:
        for k in np.flatnonzero(pattern):
            begins, each, base = slots[int(units[k])]
            begins.append(int(rank[k])), each.append(int(pattern[k])), base.append(first)
            rank[k] += pattern[k] * times
        first += times
    return {u: tuple(np.array(x, np.int64) for x in lists) for u, lists in slots.items()}


def place_pieces(pieces: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """Written pieces with sequence_id and offset."""
    by_task = stored(pieces.groupBy("units", "task").agg(F.count(F.lit(1)).alias("pieces")), "lengths")
    totals = {r["units"]: r["n"] for r in by_task.groupBy("units").agg(F.sum("pieces").alias("n")).collect()}
    units = np.array(sorted(totals), np.int64)
    demand = np.array([totals[int(u)] for u in units], np.int64)
    slots = _slots(units, whole_patterns(units, demand, sequence // UNIT))
    before = Window.partitionBy("units").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    earlier = by_task.select("units", "task", F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("earlier"))
    ranked = pieces.join(earlier, ["units", "task"])
    names = [c for c in pieces.columns if c not in ("units", "task", "number")]
    schema = ", ".join(f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in names) + ", sequence_id long"

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = batch.column("units").to_numpy()
            rank = batch.column("number").to_numpy() + batch.column("earlier").to_numpy()
            sequences = np.zeros(len(unit), np.int64)
            for u in np.unique(unit):
                begins, each, base = slots[int(u)]
                own = unit == u
                k = np.searchsorted(begins, rank[own], side="right") - 1
                sequences[own] = base[k] + (rank[own] - begins[k]) // each[k]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequences)], [*names, "sequence_id"])

    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "ids_crc32").rowsBetween(Window.unboundedPreceding, -1)
    return ranked.mapInArrow(assign, schema).withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)))


def pack(docs: DataFrame, sequence: int = SEQUENCE, **encoding) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, (ids,) sequence_id and offset of every piece of every document."""
    pieces = stored(cut_pieces(small_batches(docs), sequence, **encoding), "pieces")
    return place_pieces(passed_to(docs.sparkSession, pieces), sequence)
