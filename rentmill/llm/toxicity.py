"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text is the set of its hashed n-grams of three to five bytes in lowercase. For every n-gram the ratio of its
smoothed frequency in toxic and in clean training rows is taken as a logarithm; the n-grams that tell the labels
apart best keep a place, and a logistic regression is trained on their presence times that ratio.

Counts are made over all labelled rows in tasks, into a fixed number of cells; their texts are shuffled to the labels once and not stored. The weights are fitted on at most about
``MOST_TRAINING_ROWS`` of them (chosen by a hash of their id), a documented bound: the driver gathers the cells, and the chosen
n-grams of each training row. Labels with several rows per id count once per row. Null texts are empty.
Without labels of both kinds every score is the share of toxic labels, or 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentmill.llm.blocks import text_blocks, utf8_bytes
from rentmill.llm.filters import flag_wanted
from rentmill.llm.tables import bounded_sample, stored, tidy

CELL_BITS = 18
STRETCH_BYTES = 1 << 20
SIZES = (3, 4, 5)
MOST_TRAINING_ROWS = 20_000
FEATURES = 2048
LEAST_ROWS = 3
SMOOTHING = 0.5
STEPS = 300
RIDGE = 1e-3


@dataclass(frozen=True)
class Model:
    """``weight`` per cell of the hashed n-grams, zero for those without a place."""

    weight: np.ndarray
    bias: float


def gram_cells(column: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row number and cell of every n-gram of the texts, each once per text; only ``wanted`` cells if given.

    N-grams are made a stretch of bytes at a time, so a very long text takes memory for its distinct n-grams and not for all.
    """
    flat, starts = utf8_bytes(pc.utf8_lower(column))
    found = [np.zeros(0, np.uint64)]
    for at in range(0, len(flat), STRETCH_BYTES):
        stop = min(at + STRETCH_BYTES, len(flat))
        low = flat[at : stop + max(SIZES) - 1].astype(np.uint64)
        place = np.arange(at, stop)
        row = np.searchsorted(starts, place, side="right") - 1
        left, row = starts[row + 1] - place, row.astype(np.uint64)
        code = np.zeros(len(low), np.uint64)
        for n in range(1, max(SIZES) + 1):
            if len(low) < n:
                break
            code = (code[: len(low) - n + 1] << np.uint64(8)) | low[n - 1 :]
            if n in SIZES:
                own = code[: stop - at]
                cell = ((own + np.uint64(n << 48)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - CELL_BITS)
                inside = left[: len(own)] >= n
                if wanted is not None:
                    inside &= wanted[cell]
                found.append(np.unique(((row[: len(own)] << np.uint64(CELL_BITS)) | cell)[inside]))
    return _split(np.unique(np.concatenate(found)))


def _split(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (keys >> np.uint64(CELL_BITS)).astype(np.int64), (keys & np.uint64((1 << CELL_BITS) - 1)).astype(np.int64)


def _count_cells(training: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rows that hold each cell, by label, and rows by label."""
    every = 1 << CELL_BITS  # counts as the cell that each row holds

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, every + 1), np.int64)
        for block in text_blocks(batches, most_bytes=1 << 20):
            label = block.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
            row, cell = gram_cells(block.column("text"))
            seen[:, :every] += np.bincount(label[row] << CELL_BITS | cell, minlength=2 * every).reshape(2, -1)
            seen[:, every] += np.bincount(label, minlength=2)
        cells = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(seen[0][cells]), pa.array(seen[1][cells])], ["cell", "clean", "toxic"])

    seen = np.zeros((2, every + 1))
    counted = training.select("text", "toxic").mapInArrow(count, "cell int, clean long, toxic long")
    summed = counted.groupBy("cell").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    for batch in tidy(summed).toArrow().to_batches():
        for toxic, name in enumerate(("clean", "toxic")):
            seen[toxic, batch.column("cell").to_numpy()] = batch.column(name).to_numpy()
    return seen[:, :every], seen[:, every]


def _chosen(seen: np.ndarray, rows: np.ndarray, features: int = FEATURES, least_rows: int = LEAST_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """The cells that tell the labels apart best, by the chi-squared statistic, and their log-count ratios."""
    both = seen.sum(axis=0)
    expected = both * rows[1] / rows.sum()
    apart = np.where(both >= least_rows, (seen[1] - expected) ** 2 / np.maximum(expected, 1e-9), 0)
    cells = np.argsort(-apart, kind="stable")[:features]
    cells = np.sort(cells[apart[cells] > 0])
    p, q = ((seen[toxic][cells] + SMOOTHING) / (rows[toxic] + 2 * SMOOTHING) for toxic in (1, 0))
    return cells, np.log(p / q)


def _logistic(row: np.ndarray, feature: np.ndarray, value: np.ndarray, label: np.ndarray, features: int) -> tuple[np.ndarray, float]:
    """Gradient descent with momentum on the ridge-penalised mean log loss."""
    weight, bias = np.zeros(features), float(np.log(label.mean() / (1 - label.mean())))
    speed, bias_speed = np.zeros(features), 0.0
    norm = max(1.0, float(np.bincount(row, value**2, minlength=len(label)).mean()))
    rate = 4.0 / norm
    for _ in range(STEPS):
        score = np.bincount(row, value * weight[feature], minlength=len(label)) + bias
        off = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - label
        gradient = np.bincount(feature, value * off[row], minlength=features) / len(label) + RIDGE * weight
        speed = 0.9 * speed - rate * gradient
        bias_speed = 0.9 * bias_speed - 0.1 * off.mean()
        weight, bias = weight + speed, bias + bias_speed
    return weight, bias


def usable_labels(labels: DataFrame) -> DataFrame:
    return stored(labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", F.col("toxic").cast("int").alias("toxic")), "labels")


def labelled_texts(docs: DataFrame, usable: DataFrame) -> DataFrame:
    """doc_id, text and toxic of the documents with one of the ``usable`` labels; only texts that may have one are shuffled."""
    flagged = flag_wanted(docs.select("doc_id", "text"), "doc_id", usable.select("doc_id"), "may_be_labelled")
    return flagged.where("may_be_labelled").drop("may_be_labelled").join(usable, "doc_id")


def _training_rows(docs: DataFrame, usable: DataFrame, most_rows: int, count: int) -> DataFrame:
    """About ``most_rows`` of the ``count`` labelled texts. Their labels go to the texts, unless most labels have no text and they are many."""
    labels = bounded_sample(usable, "doc_id", most_rows, count)
    if labels.count() <= 4 * most_rows:
        return docs.select("doc_id", "text").join(F.broadcast(labels), "doc_id")
    return labelled_texts(docs, labels)


def fit(
    docs: DataFrame, labels: DataFrame, most_rows: int = MOST_TRAINING_ROWS, features: int = FEATURES, least_rows: int = LEAST_ROWS
) -> Model:
    """A model from the text of ``docs`` and the 0/1 column toxic of ``labels``, matched by doc_id.

    The log-count ratios are those of all labelled rows. The model weighs the ``features`` n-gram cells (at most 65,536) that tell the
    labels apart best, of those in ``least_rows`` rows or more; their weights are fitted in the driver on about ``most_rows`` rows. So an insult
    that fewer labelled rows hold, or that ranks behind the features, is not learned.
    """
    usable = usable_labels(labels)
    seen, rows = _count_cells(labelled_texts(docs, usable))
    weight = np.zeros(1 << CELL_BITS, np.float32)
    if not rows.all():
        return Model(weight, -30.0 if not rows[1] else 30.0)
    training = _training_rows(docs, usable, most_rows, int(rows.sum()))
    cells, ratio = _chosen(seen, rows, features, least_rows)
    place = np.full(1 << CELL_BITS, -1, np.int32)
    place[cells] = np.arange(len(cells))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, most_bytes=1 << 20):
            row, cell = gram_cells(block.column("text"), place >= 0)
            parts = np.split(place[cell].astype(np.uint16), np.searchsorted(row, np.arange(1, block.num_rows)))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("toxic"), pa.array([p.tobytes() for p in parts], pa.binary())],
                ["doc_id", "toxic", "features"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    sample = tidy(training.mapInArrow(chosen, f"doc_id {kind}, toxic int, features binary")).toArrow().to_pylist()
    sample.sort(key=lambda r: (str(r["doc_id"]), r["toxic"], r["features"]))
    held = [np.frombuffer(r["features"], np.uint16).astype(np.int64) for r in sample]
    row = np.repeat(np.arange(len(sample)), [len(h) for h in held])
    feature = np.concatenate(held)
    label = np.array([r["toxic"] for r in sample], float)
    learned, bias = _logistic(row, feature, ratio[feature], label, len(cells))
    weight[cells] = learned * ratio
    return Model(weight, bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and a score from 0 to 1 for every row, from its whole text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        wanted = known.weight != 0
        for block in text_blocks(batches, most_bytes=1 << 20):
            row, cell = gram_cells(block.column("text"), wanted)
            total = np.bincount(row, known.weight[cell], minlength=block.num_rows) + known.bias
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(total, -30, 30))))], ["doc_id", "score"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(rate, f"doc_id {kind}, score double")
