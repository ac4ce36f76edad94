"""Arrow batches of text as bounded blocks of bytes, for numpy code inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 4 << 20


def text_blocks(
    batches: Iterable[pa.RecordBatch], column: str = "text", most_bytes: int = BLOCK_BYTES, most_rows: int = 1 << 16
) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of bounded text; one text longer than the bound is a slice of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + most_bytes, side="right"))
            stop = min(max(stop, start + 1), start + most_rows, batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def utf8_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, null as empty, and where each begins (one more entry than texts)."""
    texts = pc.fill_null(column, "").cast(pa.large_utf8())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    starts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[starts[0] : starts[-1]] if data else np.zeros(0, np.uint8)
    return flat, starts - starts[0]
