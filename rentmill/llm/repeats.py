"""Removal of repeated passages: every byte of a 50-byte string that also starts in an earlier document.

Documents are compared through suffix arrays, shard by shard, where a shard gathers the places of the corpus that can be
equal. Every 50-byte window holds an anchor, its ``GRAM``-byte string with the smallest hash, and equal windows hold
equal anchors at the same place. So

1. every document gives the hashes of its anchors, and a fixed bitmap keeps those seen in two documents or more;
2. each of these gives a fingerprint of its surroundings, the bytes of all windows around it. Fingerprints are sorted by anchor,
   which tells the first document of each kind of surroundings and the anchors that have several kinds; two more
   bitmaps keep these;
3. surroundings that are not the first of their kind are removed at once. First ones go to the shard of their anchor, with their
   bytes if the anchor has several kinds, and so do those that the bitmap takes for first ones by mistake;
4. a shard sorts all suffixes of differing surroundings (Larsson and Sadakane's refinement), takes common prefixes of neighbours
   (Kasai), and gives each run of equal windows the smallest doc_id it was seen in. Anchors with more surroundings
   than a shard holds come in the order of doc_id over several shards, and the sorted windows of one shard are looked up
   by binary search in those of the shards before; of fingerprints without bytes the smallest doc_id is carried on;
5. the bytes to remove meet their text again, which gives the digests.

In surroundings the anchor itself stands as its 64-bit hash; windows are equal when the hashes and the bytes around them are.
The bitmaps are filters of a fixed size: beyond it more surroundings travel and the result is the same. Null texts are
empty. A null doc_id counts as later than all others; rows that share a doc_id, or have none, do not remove each other's text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentmill.llm.blocks import text_blocks, utf8_bytes
from rentmill.llm.filters import flag_wanted
from rentmill.llm.shingles import VALUES, _powers, mixed
from rentmill.llm.suffixes import common_prefixes, suffix_order
from rentmill.llm.tables import stored, text_of, tidy
from rentmill.operators.views import passed_to

WINDOW = 50
GRAM = 26
REACH = WINDOW - GRAM
# A window with the anchor's eight-byte hash in its place.
SHORT = REACH + 8
BLOCK_BYTES = 1 << 18  # small enough for the arrays of a block to stay in a cache
STRETCH_BITS = 20
SENT_ROWS = 1 << 14
SHARD_ROWS = 1 << 14
BITMAP_BITS = 27
SLICE_BITS = 10
BUCKET_ANCHORS = 1 << 19
LAST = np.iinfo(np.int64).max


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """The smallest or largest of every ``width`` values in a row."""
    done, size = values, 1
    while size * 2 <= width:
        done, size = pick(done[: len(done) - size], done[size:]), size * 2
    return pick(done[: len(values) - width + 1], done[width - size : len(values) - size + 1]) if size < width else done


def _hashes_of(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What hashes of any stretch of the bytes are made from: sums, and what takes a place out of them."""
    up, down = _powers(16 if len(flat) < 1 << 16 else STRETCH_BITS + 1)
    total = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(VALUES[flat] * up[: len(flat)], out=total[1:])
    return total, down


def anchors(flat: np.ndarray, starts: np.ndarray, kinds: bool = False) -> tuple[np.ndarray, ...]:
    """Places and hashes of the anchors of all texts; equal smallest hashes in one window are all anchors.

    With ``kinds`` also a hash of the surroundings of each. Windows are looked at a stretch at a time, so a very long text takes
    memory for its anchors and for one stretch.
    """
    parts = [(np.zeros(0, np.int64), *[np.zeros(0, np.uint64)] * (2 if kinds else 1))]
    for at in range(0, len(flat) - WINDOW + 1, 1 << STRETCH_BITS):
        parts.append(_anchors_from(flat, starts, at, at + (1 << STRETCH_BITS), kinds))
    if len(parts) == 2:
        return parts[1]
    found = tuple(np.concatenate(x) for x in zip(*parts))
    _, first = np.unique(found[0], return_index=True)  # windows of two stretches may have one anchor
    return tuple(x[first] for x in found)


def _anchors_from(flat: np.ndarray, starts: np.ndarray, at: int, stop: int, kinds: bool) -> tuple[np.ndarray, ...]:
    """The anchors of the windows that begin from ``at`` to before ``stop``."""
    low = max(0, at - REACH)
    part = flat[low : stop + REACH + WINDOW]
    starts = np.clip(starts - low, 0, len(part))
    total, down = _hashes_of(part)
    grams = mixed((total[GRAM:] - total[:-GRAM]) * down[: len(part) - GRAM + 1]) | np.uint64(1)
    lowest = _sliding(grams, REACH + 1, np.minimum)
    ends = np.repeat(starts[1:], np.diff(starts))[: len(lowest)]
    lowest[np.arange(len(lowest)) + WINDOW > ends] = 0
    lowest[: at - low] = 0
    lowest[stop - low :] = 0
    reached = np.concatenate([np.zeros(REACH, np.uint64), lowest, np.zeros(REACH, np.uint64)])
    places = np.flatnonzero(_sliding(reached, REACH + 1, np.maximum) == grams)
    # The smallest hashes are anything but evenly spread; mixed again they are.
    hashes = mixed(grams[places])
    if not kinds:
        return places + low, hashes
    owner = np.searchsorted(starts, places, side="right") - 1
    left, right = np.maximum(places - REACH, starts[owner]), np.minimum(places + WINDOW, starts[owner + 1])
    around = mixed((total[right] - total[left]) * down[left] + (right - left).astype(np.uint64)) ^ hashes
    return places + low, hashes, around


def _hash_counts(docs: DataFrame, bits: int) -> DataFrame:
    """(bucket, hashes): per block its anchor hashes by their leading ``bits``, twice where two of its documents have one.

    Of a hash the bucket and the 32 bits after it are kept, which suffices for a filter.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, most_bytes=BLOCK_BYTES):
            flat, starts = utf8_bytes(block.column("text"))
            places, hashes = anchors(flat, starts)
            if not len(places):
                continue
            owner = np.searchsorted(starts, places, side="right")
            order = np.argsort(hashes, kind="stable")
            hashes, owner = hashes[order] >> np.uint64(32 - bits), owner[order]
            new = np.r_[True, hashes[1:] != hashes[:-1]]
            again = np.r_[False, ~new[1:] & (owner[1:] != owner[:-1])]
            kept = np.sort(np.concatenate([hashes[new], np.unique(hashes[again])]))
            bucket = (kept >> np.uint64(32)).astype(np.int64)
            first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            blobs = [part.tobytes() for part in np.split(kept.astype(np.uint32), first[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[first]), pa.array(blobs, pa.binary())], ["bucket", "hashes"])

    return docs.select("text").mapInArrow(gather, "bucket long, hashes binary")


def repeated_anchors(docs: DataFrame) -> np.ndarray:
    """A bitmap over the leading ``BITMAP_BITS`` bits of the anchor hashes that two documents share."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(32, max(6, int(size // (BUCKET_ANCHORS * (REACH + 2) // 2)).bit_length()))

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        current = None

        def finish() -> Iterator[pa.RecordBatch]:
            every = np.sort(np.concatenate(held))
            whole = (np.uint64(current) << np.uint64(32)) | every[1:][every[1:] == every[:-1]]
            if len(whole):
                yield _cell_rows(0, (whole >> np.uint64(bits + 32 - BITMAP_BITS)).astype(np.int64))

        for batch in batches:
            for bucket, hashes in zip(batch.column("bucket").to_pylist(), batch.column("hashes").to_pylist()):
                if bucket != current and held:
                    yield from finish()
                    held = []
                current = bucket
                held.append(np.frombuffer(hashes, np.uint32))
        if held:
            yield from finish()

    counted = _hash_counts(docs, bits).repartition("bucket").sortWithinPartitions("bucket")
    return _bitmaps(counted.mapInArrow(repeated, CELLS), 1)[0]


CELLS = "bitmap int, slice long, cells binary"


def _cell_rows(bitmap: int, cells: np.ndarray) -> pa.RecordBatch:
    """Distinct cells of a bitmap by slice."""
    cells = np.unique(cells)
    part = cells >> (BITMAP_BITS - SLICE_BITS)
    first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    blobs = [p.astype(np.int32).tobytes() for p in np.split(cells, first[1:])]
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(first), bitmap, np.int32)), pa.array(part[first]), pa.array(blobs, pa.binary())], ["bitmap", "slice", "cells"])


def _bitmaps(cells: DataFrame, count: int) -> list[np.ndarray]:
    """Bitmaps with the given cells set, put together slice by slice in tasks."""

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for *name, blob in zip(*(batch.column(c).to_pylist() for c in ("bitmap", "slice", "cells"))):
                part = bits.setdefault(tuple(name), np.zeros(1 << (BITMAP_BITS - SLICE_BITS), bool))
                part[np.frombuffer(blob, np.int32) & (len(part) - 1)] = True
        if bits:
            packed = [np.packbits(part).tobytes() for part in bits.values()]
            columns = [pa.array([n[0] for n in bits], pa.int32()), pa.array([n[1] for n in bits], pa.int64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["bitmap", "slice", "cells"])

    made = np.zeros((count, 1 << SLICE_BITS, 1 << (BITMAP_BITS - SLICE_BITS - 3)), np.uint8)
    for row in cells.repartition("bitmap", "slice").mapInArrow(drawn, CELLS).collect():
        made[row["bitmap"], row["slice"]] = np.frombuffer(row["cells"], np.uint8)
    return [bitmap.ravel() for bitmap in made]


def _is_set(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the cell of the leading bits of each hash is set."""
    cells = hashes >> np.uint64(64 - BITMAP_BITS)
    return (bitmap[(cells >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (cells & np.uint64(7)).astype(np.uint8))) & 1 == 1


def _pair_hash(kinds: np.ndarray, docs: np.ndarray) -> np.ndarray:
    return mixed(kinds ^ mixed(docs.view(np.uint64)))


class _Surroundings:
    """The repeated anchors of a block: place, hash, text, reach and a fingerprint of what is around."""

    def __init__(self, block: pa.RecordBatch, repeated: np.ndarray):
        self.flat, self.starts = utf8_bytes(block.column("text"))
        places, hashes, kinds = anchors(self.flat, self.starts, kinds=True)
        hit = _is_set(repeated, hashes)
        self.places, self.hashes, self.kinds = places[hit], hashes[hit], kinds[hit]
        self.owner = np.searchsorted(self.starts, self.places, side="right") - 1
        self.low = np.maximum(self.places - REACH, self.starts[self.owner])
        self.high = np.minimum(self.places + WINDOW, self.starts[self.owner + 1])
        self.docs_of = block.column("doc_id").cast(pa.int64()).fill_null(LAST).to_numpy()
        self.docs = self.docs_of[self.owner]


def _first_kinds(docs: DataFrame, repeated: np.ndarray) -> list[np.ndarray]:
    """Two bitmaps: pairs of surroundings and their first document, and anchors with several kinds of surroundings."""
    shared = docs.sparkSession.sparkContext.broadcast(repeated)

    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, most_bytes=BLOCK_BYTES):
            found = _Surroundings(block, shared.value)
            if len(found.places):
                order = np.lexsort((found.docs, found.kinds))
                order = order[np.r_[True, found.kinds[order][1:] != found.kinds[order][:-1]]]
                anchor = (found.hashes[order] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(found.kinds[order].view(np.int64)), pa.array(found.docs[order])], ["anchor", "kind", "doc"])

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, size = None, ([], []), 0

        def emptied() -> Iterator[pa.RecordBatch]:
            nonlocal held
            for bitmap, cells in enumerate(held):
                if sum(map(len, cells)):
                    yield _cell_rows(bitmap, np.concatenate(cells))
            held = ([], [])

        for batch in batches:
            anchor, kind, doc = (batch.column(c).to_numpy() for c in ("anchor", "kind", "doc"))
            if not len(anchor):
                continue
            same_anchor = np.r_[last is not None and last[0] == anchor[0], anchor[1:] == anchor[:-1]]
            new = ~same_anchor | np.r_[last is None or last[1] != kind[0], kind[1:] != kind[:-1]]
            last = (anchor[-1], kind[-1])
            pairs = _pair_hash(kind[new].view(np.uint64), doc[new]) >> np.uint64(64 - BITMAP_BITS)
            several = anchor[new & same_anchor].view(np.uint32) >> np.uint32(32 - BITMAP_BITS)
            held[0].append(pairs.astype(np.int64))
            held[1].append(np.unique(several).astype(np.int64))
            size += len(pairs)
            if size >= 1 << 20:
                yield from emptied()
                size = 0
        yield from emptied()

    sorted_kinds = docs.select("doc_id", "text").mapInArrow(fingerprints, "anchor int, kind long, doc long").repartition("anchor").sortWithinPartitions("anchor", "kind", "doc")
    return _bitmaps(sorted_kinds.mapInArrow(firsts, CELLS), 2)


def _joined(owner: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches that overlap or touch within an owner as one; ``low`` and ``high`` rise from owner to owner."""
    order = np.lexsort((low, owner))
    owner, low, high = owner[order], low[order], high[order]
    far = np.maximum.accumulate(high)
    first = np.flatnonzero(np.r_[True, (low[1:] > far[:-1]) | (owner[1:] != owner[:-1])])
    return owner[first], low[first], far[np.r_[first[1:] - 1, len(far) - 1]]


# Rows that share a doc_id, or have none, are told apart by the two halves of their text's MD5.
ROW = ["doc", "variant", "second"]
SENT = "doc long, variant long, second long, start int, stop int, hash long, around binary"


def _sent(docs: DataFrame) -> DataFrame:
    """Surroundings for the shards (with hash and bytes), and stretches already known to be removed (without)."""
    repeated = repeated_anchors(docs)
    shared = docs.sparkSession.sparkContext.broadcast((repeated, *_first_kinds(docs, repeated)))
    names = [*ROW, "start", "stop", "hash", "around"]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated, first_pairs, several_kinds = shared.value
        for block in text_blocks(batches, most_bytes=BLOCK_BYTES):
            found = _Surroundings(block, repeated)
            if not len(found.places):
                continue
            flat, starts, owner = found.flat, found.starts, found.owner
            data, variant = flat.tobytes(), np.zeros((block.num_rows, 2), np.int64)
            for k in np.unique(owner):
                variant[k] = np.frombuffer(hashlib.md5(data[starts[k] : starts[k + 1]], usedforsecurity=False).digest(), ">i8")
            first = _is_set(first_pairs, _pair_hash(found.kinds, found.docs))
            if not first.all():
                of, begin, end = _joined(owner[~first], found.low[~first], found.high[~first])
                columns = [pa.array(found.docs_of[of]), *map(pa.array, variant[of].T.copy()), pa.array(begin - starts[of], pa.int32()), pa.array(end - starts[of], pa.int32())]
                yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(of), pa.int64()), pa.nulls(len(of), pa.binary())], names)
            several = _is_set(several_kinds, found.hashes)
            chosen_rows = [(np.flatnonzero(first & several), True), (np.flatnonzero(first & ~several), False)]
            for chosen, whole in [(rows[at : at + SENT_ROWS], whole) for rows, whole in chosen_rows for at in range(0, len(rows), SENT_ROWS)]:
                of, low, high, place = owner[chosen], found.low[chosen], found.high[chosen], found.places[chosen]
                if whole:
                    near = place[:, None] + np.r_[np.arange(-REACH, 0), np.zeros(8, np.int64), np.arange(GRAM, WINDOW)]
                    inside = (near >= low[:, None]) & (near < high[:, None])
                    around = flat[np.clip(near, 0, len(flat) - 1)]
                    around[:, REACH : REACH + 8] = found.hashes[chosen].view(np.uint8).reshape(-1, 8)
                else:
                    inside, around = np.ones((len(chosen), 8), bool), found.kinds[chosen].view(np.uint8).reshape(-1, 8)
                offsets = np.r_[0, np.cumsum(inside.sum(axis=1))].astype(np.int32)
                blob = pa.BinaryArray.from_buffers(pa.binary(), len(chosen), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(around[inside].tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.docs_of[of]), *map(pa.array, variant[of].T.copy()), pa.array(low - starts[of], pa.int32()), pa.array(high - starts[of], pa.int32()),
                     pa.array(found.hashes[chosen].view(np.int64)), blob], names
                )

    return docs.select("doc_id", "text").mapInArrow(send, SENT)


def _earliest(texts: np.ndarray, lengths: np.ndarray, docs: np.ndarray, known: tuple | None):
    """The smallest doc of every window of the texts (one after another), and the windows in order with theirs.

    ``known`` holds the windows of earlier shards and their smallest docs, in order.
    """
    order = suffix_order(texts)
    shared = common_prefixes(texts, order, SHORT)
    ends = np.cumsum(lengths)
    text_of = np.repeat(np.arange(len(lengths)), lengths)
    whole = order + SHORT <= ends[text_of[order]]
    # Windows that run over the end of their text are left out; the smallest common prefix in between still holds.
    runs = np.cumsum(shared < SHORT)[whole]
    windows = order[whole]
    if not len(windows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), (np.zeros(0, f"S{SHORT}"), np.zeros(0, np.int64))
    first = np.flatnonzero(np.r_[True, runs[1:] != runs[:-1]])
    least = np.minimum.reduceat(docs[text_of[windows]], first)
    content = np.ascontiguousarray(texts[windows[first][:, None] + np.arange(SHORT)]).view(f"S{SHORT}").ravel()
    if known is not None and len(known[0]):
        at = np.minimum(np.searchsorted(known[0], content), len(known[0]) - 1)
        least = np.where(known[0][at] == content, np.minimum(least, known[1][at]), least)
    sizes = np.diff(np.r_[first, len(windows)])
    return windows, np.repeat(least, sizes), (content, least)


def _shard_spans(hashes, rows, places, stops, arounds, known, more: bool):
    """What to remove in the rows (doc, variant, second) of one shard, and its windows in order.

    ``known``: windows of the shards before for an anchor that began there, and the smallest doc of each of its fingerprints
    without bytes; ``more``: the anchor goes on after this shard.
    """
    docs = rows[:, 0]
    kinds: dict[bytes, int] = {}
    kind = np.array([kinds.setdefault(a, len(kinds)) for a in arounds], np.int64)
    lengths = np.array([len(a) for a in kinds], np.int64)
    least = np.full(len(kinds), LAST)
    np.minimum.at(least, kind, docs)
    for text, doc in (known[2] if known is not None else {}).items():
        if text in kinds:
            least[kinds[text]] = min(least[kinds[text]], doc)
    prints = {text: least[k] for text, k in kinds.items() if len(text) < SHORT}
    # Surroundings that are the only ones of their anchor repeat as a whole or not at all.
    _, first = np.unique(kind, return_index=True)
    _, anchor, each = np.unique(hashes[first], return_inverse=True, return_counts=True)
    alone = (each[anchor] == 1) & (known is None) & (not more)
    whole = docs > least[kind]
    found = [(rows[whole], places[whole], stops[whole])]
    table = (np.zeros(0, f"S{SHORT}"), np.zeros(0, np.int64))
    if not alone.all():
        several = np.flatnonzero(~alone)
        number = np.full(len(kinds), -1)
        number[several] = np.arange(len(several))
        texts = list(kinds)
        joined = np.frombuffer(b"".join(texts[k] for k in several), np.uint8)
        windows, earliest, table = _earliest(joined, lengths[several], least[several], known)
        begin = np.r_[0, np.cumsum(lengths[several])]
        of = np.searchsorted(begin, windows, side="right") - 1
        seen = np.full((len(several), REACH + 1), LAST)
        seen[of, windows - begin[of]] = earliest
        open_rows = np.flatnonzero(~whole & ~alone[kind])
        gone = seen[number[kind[open_rows]]] < docs[open_rows][:, None]
        some = gone.any(axis=1)
        open_rows, gone = open_rows[some], gone[some]
        high = REACH - gone[:, ::-1].argmax(axis=1) + WINDOW
        found.append((rows[open_rows], places[open_rows] + gone.argmax(axis=1), places[open_rows] + high))
    return [np.concatenate([f[k] for f in found]) for k in range(3)], (*table, prints)


def _merge_windows(known, table):
    """Two ordered window tables with fingerprints as one, the smallest doc of equal windows staying."""
    if known is None:
        return table
    content, least = np.concatenate([known[0], table[0]]), np.concatenate([known[1], table[1]])
    order = np.argsort(content, kind="stable")
    content, least = content[order], least[order]
    first = np.flatnonzero(np.r_[len(content) > 0, content[1:] != content[:-1]])
    return content[first], np.minimum.reduceat(least, first) if len(first) else least, known[2] | table[2]


def _spans(sent: DataFrame) -> DataFrame:
    """(doc, variant, second, start, stop) of what repeats earlier documents."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        known, known_hash = None, None  # windows of an anchor whose rows fill several shards

        def shard(rows: pa.RecordBatch, goes_on: bool) -> Iterator[pa.RecordBatch]:
            nonlocal known, known_hash
            hashes = rows.column("hash").to_numpy()
            carried = int(np.count_nonzero(hashes == known_hash)) if known is not None else 0
            for part, earlier in ((slice(0, carried), known), (slice(carried, len(hashes)), None)):
                if part.start == part.stop:
                    continue
                own = rows.slice(part.start, part.stop - part.start)
                found, table = _shard_spans(
                    hashes[part], np.column_stack([own.column(c).to_numpy() for c in ROW]),
                    *(own.column(c).to_numpy().astype(np.int64) for c in ("start", "stop")), own.column("around").to_pylist(), earlier, goes_on,
                )
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, found[0].T.copy()), pa.array(found[1], pa.int32()), pa.array(found[2], pa.int32())], [*ROW, "start", "stop"],
                )
            if goes_on:
                known, known_hash = _merge_windows(known if carried else None, table), hashes[-1]
            else:
                known = None

        for batch in batches:
            done = batch.filter(pc.is_null(batch.column("hash")))
            if done.num_rows:
                yield done.select([*ROW, "start", "stop"])
            batch = batch.filter(pc.is_valid(batch.column("hash")))
            for at in range(0, batch.num_rows, SHARD_ROWS):
                held.append(batch.slice(at, SHARD_ROWS))
                if sum(h.num_rows for h in held) < SHARD_ROWS:
                    continue
                rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                hashes = rows.column("hash").to_numpy()
                own = int(np.searchsorted(hashes, hashes[-1]))  # the last anchor may go on
                if own:
                    yield from shard(rows.slice(0, own), False)
                    held = [rows.slice(own)]
                else:
                    yield from shard(rows, True)
                    held = []
        if held:
            yield from shard(pa.Table.from_batches(held).combine_chunks().to_batches()[0], False)

    place = F.when(F.col("hash").isNull(), F.xxhash64("doc")).otherwise(F.col("hash"))
    return sent.repartition(place).sortWithinPartitions("hash", "doc").mapInArrow(search, "doc long, variant long, second long, start int, stop int")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (null where all of the text stays) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = _spans(_sent(tidy(docs.select("doc_id", "text"))))
    found = stored(found.groupBy(*ROW).agg(F.collect_set(F.struct("start", "stop")).alias("spans")), "spans")
    spans = passed_to(docs.sparkSession, found)
    digest = F.md5(text_of().cast("binary"))
    halves = [F.conv(F.substring(digest, at, 16), 16, -10).cast("long").alias(name) for at, name in ((1, "variant"), (17, "second"))]
    named = docs.select(F.col("doc_id"), text_of().cast("binary").alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), *halves)
    # Only texts that may have spans are shuffled to meet them.
    wanted = stored(spans.select(F.xxhash64(*ROW).alias("name")), "names")
    flagged = flag_wanted(named.withColumn("name", F.xxhash64(*ROW)), "name", wanted, "may_have")
    none = F.lit(None).cast(spans.schema["spans"].dataType).alias("spans")
    alone = flagged.where("NOT may_have").select("doc_id", "text", none)
    texts = alone.unionByName(flagged.where("may_have").join(spans, ROW, "left").select("doc_id", "text", "spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                kept, at, removed, runs = [], 0, 0, 0
                end = -1
                for span in sorted(spans or [], key=lambda s: (s["start"], s["stop"])):
                    start, stop = max(span["start"], at), span["stop"]
                    if span["start"] > end:
                        runs += 1
                    end = max(end, stop)
                    if stop > start:
                        kept.append(text[at:start])
                        removed += stop - start
                        at = stop
                kept = b"".join([*kept, text[at:]])
                made.append((len(text), removed, runs, hashlib.sha256(kept).hexdigest(), kept if removed else None))
            columns = [pa.array([m[k] for m in made], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return texts.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
