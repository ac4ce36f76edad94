"""Language identification by the nearest of several centroids per language.

A text is a vector of hashed byte n-grams of its lowercase letters (one to three bytes), weighted by
(1 + ln count) times the inverse document frequency and scaled to length one. Each language has a few centroids from
spherical k-means; the language of the centroid with the largest cosine is predicted and that cosine is the score.

A prediction is rejected if its cosine is below a limit. Cosines rise with the number of distinct n-grams in a text, so
each language has a limit per power of the root of two of that number: ``REJECT_SHARE`` of the cosine that all but a hundredth of its
training texts, and of their first 3 to 512 characters, reach with centroids fitted without them (in ``FOLDS`` parts). Where
fewer than ``LEAST_VALUES`` were measured the limit for shorter texts holds, and below all measured lengths nothing is
rejected. A text without letters (or null) is ``und`` and rejected.

Document frequencies are counted over all training rows, in tasks, into one fixed number of dimensions. Centroids are
fitted on at most about ``SAMPLE_PER_LANGUAGE`` training rows of each language and ``MOST_ROWS`` in all, a documented bound on what
the driver gathers; rows are chosen by a hash of their id. The model is broadcast: dimensions times centroids, whatever the input.
Without training rows every text is ``und``.
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
from rentmill.llm.tables import small_batches

DIMENSIONS = 4096
SAMPLE_PER_LANGUAGE = 400
MOST_ROWS = 12_000
CENTROIDS = 4
ROUNDS = 12
REJECT_SHARE = 0.8
FOLDS = 4
LEAST_VALUES = 8
CUTS = [n << k for k in range(8) for n in (3, 4)]
UNKNOWN = "und"
BLOCK_ROWS = 64  # 2 MB of counts; workers keep what a block took
BLOCK_BYTES = 1 << 18
STRETCH_BYTES = 1 << 18
SPACE = 32
SPACED = np.arange(256, dtype=np.uint8)
SPACED[[b for b in range(128) if not chr(b).isalpha()]] = SPACE


def has_letter(text: str) -> bool:
    """Whether a character is of Unicode's category of letters; numerals such as ``½`` or ``Ⅷ`` are none."""
    return any(map(str.isalpha, text))


@dataclass(frozen=True)
class Model:
    languages: list[str]
    weights: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    limits: np.ndarray  # per language and step of distinct n-grams, see ``_lengths``


def gram_counts(column: pa.Array) -> np.ndarray:
    """A row of n-gram counts per text, over letters, runs of anything else in ASCII being one space."""
    flat, starts = utf8_bytes(pc.utf8_lower(column))
    flat = SPACED[flat]
    kept = np.ones(len(flat), bool)
    kept[1:] = (flat[1:] != SPACE) | (flat[:-1] != SPACE)
    sizes = np.array([np.count_nonzero(kept[a:b]) for a, b in zip(starts[:-1], starts[1:])], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    flat = flat[kept]
    rows = len(sizes)
    counts = np.zeros(rows * DIMENSIONS, np.int64)
    for at in range(0, len(flat), STRETCH_BYTES):  # a stretch at a time: a very long text is counted, not held several times
        stop = min(at + STRETCH_BYTES, len(flat))
        low = flat[at : stop + 2].astype(np.uint32)
        place = np.arange(at, stop)
        row = np.searchsorted(starts, place, side="right") - 1
        left, row = starts[row + 1] - place, row * DIMENSIONS
        code = np.zeros(len(low), np.uint32)
        for n in (1, 2, 3):
            if len(low) < n:
                break
            code = (code[: len(low) - n + 1] << 8) | low[n - 1 :]
            own = code[: stop - at]
            hashed = ((own + np.uint32(n << 24)) * np.uint32(2654435761)) >> np.uint32(20)
            inside = left[: len(own)] >= n
            counts += np.bincount((row[: len(own)] + hashed)[inside], minlength=len(counts))
    return counts.reshape(rows, DIMENSIONS)


def _vectors(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    scaled = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1), dtype=np.float32), 0).astype(np.float32) * weights
    return scaled / np.maximum(np.linalg.norm(scaled, axis=1, keepdims=True), 1e-12)


def _clusters(vectors: np.ndarray) -> np.ndarray:
    """Spherical k-means; starts from the texts that are least like the centres chosen so far."""
    centres = vectors.mean(axis=0, keepdims=True)
    while len(centres) < min(CENTROIDS, len(vectors)):
        centres = np.vstack([centres, vectors[np.argmin((vectors @ centres.T).max(axis=1))]])
    for _ in range(ROUNDS):
        nearest = np.argmax(vectors @ centres.T, axis=1)
        centres = np.vstack([vectors[nearest == k].mean(axis=0) if np.any(nearest == k) else centres[k] for k in range(len(centres))])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    return centres


def _lengths(counts: np.ndarray) -> np.ndarray:
    """The number of distinct n-grams of each row, in whole powers of the root of two."""
    return (2 * np.log2(np.maximum((counts > 0).sum(axis=1), 1))).astype(np.int64)


def _limits(counts: np.ndarray, starts: list[str], weights: np.ndarray) -> np.ndarray:
    """Limits of one language from its texts' counts and beginnings, each measured with centroids of the other parts."""
    fold = np.arange(len(counts)) % FOLDS
    lengths, cosines = [], []
    for k in range(min(FOLDS, len(counts)) if len(counts) > 1 else 0):
        centres = _clusters(_vectors(counts[fold != k], weights))
        held = [starts[i] for i in np.flatnonzero(fold == k)]
        cut = [gram_counts(pa.array(texts)) for n in CUTS if (texts := [t[:n] for t in held if len(t) > n and has_letter(t[:n])])]
        for own in [counts[fold == k], *cut]:
            lengths.append(_lengths(own))
            cosines.append((_vectors(own, weights) @ centres.T).max(axis=1))
    limits = np.zeros(int(2 * np.log2(DIMENSIONS)) + 1)
    for k in range(len(limits)):
        own = np.concatenate(cosines)[np.concatenate(lengths) == k] if cosines else []
        limits[k] = REJECT_SHARE * float(np.quantile(own, 0.01)) if len(own) >= LEAST_VALUES else limits[max(k - 1, 0)]
    return limits


def fit(training: DataFrame, sample_per_language: int = SAMPLE_PER_LANGUAGE, most_rows: int = MOST_ROWS) -> Model:
    """A model from the columns doc_id, text and lang; rows without text or lang teach nothing.

    Document frequencies are counted over all rows. Centroids and limits are fitted in the driver on about ``sample_per_language`` rows of
    each language and ``most_rows`` in all (8 KB of counts a row), fewer of each where there are very many languages.
    """
    rows = small_batches(training.where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(DIMENSIONS, np.int64)
        for block in text_blocks(batches, most_bytes=BLOCK_BYTES, most_rows=BLOCK_ROWS):
            seen += (gram_counts(block.column("text")) > 0).sum(axis=0)
        kept = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int32()), pa.array(seen[kept])], ["dimension", "seen"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, most_bytes=BLOCK_BYTES, most_rows=BLOCK_ROWS):
            counts = np.minimum(gram_counts(block.column("text")), 65535).astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("lang"), pa.array([c.tobytes() for c in counts], pa.binary()),
                 pc.utf8_slice_codeunits(block.column("text"), 0, CUTS[-1] + 1)],
                ["doc_id", "lang", "counts", "begin"],
            )

    per_language = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(per_language.values())
    if not total:
        return Model([], np.zeros(DIMENSIONS), np.zeros((0, DIMENSIONS)), np.zeros(0, int), np.zeros((0, 0)))
    seen = np.zeros(DIMENSIONS)
    for r in rows.mapInArrow(frequencies, "dimension int, seen long").groupBy("dimension").agg(F.sum("seen").alias("n")).collect():
        seen[r["dimension"]] = r["n"]
    weights = np.log((1 + total) / (1 + seen)).astype(np.float32) + np.float32(0.1)
    bound = min(sample_per_language, max(1, most_rows // len(per_language)))
    shares = F.create_map(*(F.lit(x) for lang, n in sorted(per_language.items()) for x in (lang, min(1.0, bound / n))))
    chosen = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < shares[F.col("lang")] * (1 << 30))
    kind = rows.schema["doc_id"].dataType.simpleString()
    sample = sorted(chosen.mapInArrow(counted, f"doc_id {kind}, lang string, counts binary, begin string").collect(), key=lambda r: (r["lang"], str(r["doc_id"]), r["counts"], r["begin"]))
    languages, centroids, owner, limits = sorted(per_language), [], [], []
    for number, lang in enumerate(languages):
        own = [r for r in sample if r["lang"] == lang]
        counts = np.array([np.frombuffer(r["counts"], np.uint16) for r in own], np.int64).reshape(-1, DIMENSIONS)
        limits.append(_limits(counts, [r["begin"] for r in own], weights))
        if not own:
            continue
        vectors = _vectors(counts, weights)
        centres = _clusters(vectors)
        nearest = np.argmax(vectors @ centres.T, axis=1)
        for centre in centres[np.unique(nearest)]:
            centroids.append(centre), owner.append(number)
    return Model(languages, weights, np.vstack(centroids).astype(np.float32), np.array(owner), np.vstack(limits))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and rejected of every row; only the text decides."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for block in text_blocks(batches, most_bytes=BLOCK_BYTES, most_rows=BLOCK_ROWS):
            texts = block.column("text").to_pylist()
            names, scores, rejected = [], [], []
            if len(known.centroids):
                counts = gram_counts(block.column("text"))
                cosines = _vectors(counts, known.weights) @ known.centroids.T
                nearest = np.argmax(cosines, axis=1)
                limits = known.limits[known.owner[nearest], _lengths(counts)]
            for k, text in enumerate(texts):
                if not text or not len(known.centroids) or not has_letter(text):
                    names.append(UNKNOWN), scores.append(0.0), rejected.append(True)
                    continue
                best = int(nearest[k])
                score = float(min(1.0, max(0.0, cosines[k, best])))
                names.append(known.languages[known.owner[best]]), scores.append(score)
                rejected.append(bool(score < limits[k]))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(label, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def keep_accepted(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows whose text the model rejects, in a session of its own; rows are not shuffled and keep all columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def accept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for block in text_blocks(batches, most_bytes=BLOCK_BYTES, most_rows=BLOCK_ROWS):
            if not len(known.centroids):
                continue
            counts = gram_counts(block.column("text"))
            cosines = _vectors(counts, known.weights) @ known.centroids.T
            nearest = np.argmax(cosines, axis=1)
            scores = np.clip(cosines[np.arange(len(nearest)), nearest].astype(np.float64), 0, 1)
            good = scores >= known.limits[known.owner[nearest], _lengths(counts)]
            letters = [bool(text and has_letter(text)) for text in block.column("text").to_pylist()]
            yield block.filter(pa.array(good & np.array(letters)))

    return small_batches(docs).mapInArrow(accept, docs.schema)
