"""Jaccard join of word shingle sets: a size-aware heavy-light join, and the components of its links.

Texts with the same set are one class, named by a hash of the set; only classes are compared. Two sets of
similarity ``s`` or more share ``c`` shingles among the first ``n - ceil(s n) + c`` of each in any common order. ``c`` is
two, or a twentieth of the set if that is more, so a class that is in fewer lists than its ``c`` has no link and
a passage that is common to long documents does not make them candidates. The order is by how often a cell of a fixed count sketch was hit, so passages that many documents share come
last and hardly ever decide; any order gives the same links, so the sketch only sets the cost.

* Heavy sets are found by scanning inverted lists: every class posts its prefix shingles, and a list with two classes or more
  makes its members candidates of each other.
* Light sets are found by enumerating subsets: every pair of listed shingles of a light class is a signature, and lists
  without a heavy member are dropped.
* The boundary is the size at which the rows that pairs would make, summed over all smaller classes, are fewest compared with the
  rows that scanning makes.

A list is never expanded into pairs. First every member is tested against the list's hub, its first member, and the links
found are joined to components. Then, in each list that still holds several components, the classes outside the
largest are compared with all members in blocks: an inverted index over one block is scanned for the sets of
another, counting intersections exactly. Blocks are bounded by shingles and by rows, as the counts are one number per pair
of rows of two blocks. So no link between components is lost, and copies of one text cost one link each.

Shingles found several times within a block of documents are combined before the shuffle. Null and empty texts have no
shingles and no links. Rows that share a doc_id count as one document whose links are those of all its rows; a
row without doc_id takes the smallest doc_id of its component, or none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rentmill.llm.blocks import text_blocks, utf8_bytes
from rentmill.llm.components import connected_components
from rentmill.llm.filters import flag_wanted
from rentmill.llm.shingles import set_id, shingle_sets
from rentmill.llm.tables import discard, stored, tidy
from rentmill.operators.views import passed_to

PERCENT = 80
CELL_BITS = 21
SLICES = 64
BLOCK_BYTES = 2 << 20
BLOCK_SHINGLES = 1 << 17
BLOCK_ROWS = 1 << 11
MOST_MATCHES = 1 << 22
ROWS_PER_POSTING = 2
PREFIX_SHARE = 20


def measured(docs: DataFrame) -> DataFrame:
    """A row per document (doc_id, n, node) and, per task, rows (slice, counts) of the count sketch."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, kind = np.zeros(1 << CELL_BITS, np.int64), pa.int64()
        for block in text_blocks(batches, most_bytes=BLOCK_BYTES):
            kind = block.column("doc_id").type
            sets = shingle_sets(*utf8_bytes(block.column("text")))
            cells = (np.concatenate(sets) >> np.uint64(64 - CELL_BITS)).astype(np.int64)
            sketch += np.bincount(cells, minlength=len(sketch))
            rows = block.num_rows
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_id(s) for s in sets], pa.int64()),
                 pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())],
                ["doc_id", "n", "node", "slice", "counts"],
            )
        if sketch.any():
            parts = np.minimum(sketch, np.iinfo(np.uint32).max).astype(np.uint32).reshape(SLICES, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(SLICES, kind), pa.nulls(SLICES, pa.int64()), pa.nulls(SLICES, pa.int64()),
                 pa.array(range(SLICES), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
                ["doc_id", "n", "node", "slice", "counts"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(measure, f"doc_id {kind}, n long, node long, slice int, counts binary")


def _sketch(parts: DataFrame) -> np.ndarray:
    """The counts of all tasks added up, slice by slice."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, counts in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist()):
                part = np.frombuffer(counts, np.uint32).astype(np.int64)
                sums[number] = sums[number] + part if number in sums else part
        if sums:
            capped = [np.minimum(s, np.iinfo(np.uint32).max).astype(np.uint32).tobytes() for s in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(capped, pa.binary())], ["slice", "counts"])

    whole = np.zeros((SLICES, (1 << CELL_BITS) // SLICES), np.uint32)
    for row in parts.repartition(SLICES, "slice").mapInArrow(add, "slice int, counts binary").collect():
        whole[row["slice"]] = np.frombuffer(row["counts"], np.uint32)
    return whole.ravel()


def prefix_length(n: int, percent: int, common: int) -> int:
    """How many shingles to take so that sets of the similarity share ``common`` of them."""
    return min(n, n - -(-percent * n // 100) + common)


def shared_shingles(n: int) -> int:
    """How many prefix shingles linked sets share: the ``c`` of a set of ``n``."""
    return max(2, n // PREFIX_SHARE)


def _needed(percent: int):
    """The ``c`` of the smallest set that can be linked to one of ``n``, as a column."""
    return F.expr(f"greatest(2L, (({percent} * n + 99) div 100) div {PREFIX_SHARE})")


def _postings(docs: DataFrame, sketch: np.ndarray, percent: int) -> DataFrame:
    """(sig, node, hub) of prefix shingles. A hub is given where the block alone makes a list."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = shared.value
        for block in text_blocks(batches, most_bytes=BLOCK_BYTES):
            sigs, nodes = [], {}
            for s in shingle_sets(*utf8_bytes(block.column("text"))):
                # A set that one shingle more would already make too different has no links.
                if len(s) * 100 >= percent * (len(s) + 1) and (node := set_id(s)) not in nodes:
                    count = prefix_length(len(s), percent, shared_shingles(len(s)))
                    order = np.argsort(often[(s >> np.uint64(64 - CELL_BITS)).astype(np.int64)], kind="stable")[:count]
                    nodes[node] = count
                    sigs.append(s[order])
            if not sigs:
                continue
            sig = np.concatenate(sigs).view(np.int64)
            node = np.repeat(np.fromiter(nodes, np.int64, len(nodes)), list(nodes.values()))
            order = np.lexsort((node, sig))
            sig, node = sig[order], node[order]
            first = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
            sizes = np.diff(np.r_[first, len(sig)])
            several = np.repeat(sizes > 1, sizes)
            hubs = np.repeat(node[first], sizes)[several]
            nothing = pa.nulls(len(first), pa.int64())
            for columns in ([pa.array(sig[first]), pa.array(node[first]), nothing], [pa.array(sig[several]), pa.array(node[several]), pa.array(hubs)]):
                yield pa.RecordBatch.from_arrays(columns, ["sig", "node", "hub"])

    return docs.select("text").mapInArrow(post, "sig long, node long, hub long")


def _lists(postings: DataFrame) -> DataFrame:
    """(sig, node, hub) of every list with two classes or more; postings with a hub pass through."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # signature, hub, last node, whether the hub was given out
        for batch in batches:
            known = batch.filter(pc.is_valid(batch.column("hub")))
            if known.num_rows:
                yield known
            new = batch.filter(pc.is_null(batch.column("hub")))
            sig, node = new.column("sig").to_numpy(), new.column("node").to_numpy()
            if not len(sig):
                continue
            given = bool(last and last[0] == sig[0])
            if given:
                sig, node = np.r_[last[0], sig], np.r_[last[2], node]
            keep = np.r_[True, (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])]
            sig, node = sig[keep], node[keep]
            first = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
            sizes = np.diff(np.r_[first, len(sig)])
            hubs = np.repeat(node[first], sizes)
            out = np.repeat(sizes > 1, sizes)
            if given:
                hubs[: sizes[0]] = last[1]
                if last[3]:  # the carried row was given out before
                    out[0] = False
                elif sizes[0] > 1 and last[1] != last[2]:
                    out[0] = False
            final_given = bool(sizes[-1] > 1 or (given and len(first) == 1 and last[3]))
            last = (sig[-1], hubs[-1], node[-1], final_given)
            if out.any():
                yield pa.RecordBatch.from_arrays([pa.array(sig[out]), pa.array(node[out]), pa.array(hubs[out])], ["sig", "node", "hub"])

    place = F.when(F.col("hub").isNull(), F.col("sig")).otherwise(F.xxhash64("node"))
    return postings.repartition(place).sortWithinPartitions("sig", "node").mapInArrow(listed, "sig long, node long, hub long")


def _often_listed(lists: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """(sig, node, hub, n, m): the lists without the classes that are in too few of them, ``m``, to have a link."""
    placed = stored(lists.select("sig", "node").distinct(), "listed")
    often = placed.groupBy("node").agg(F.count(F.lit(1)).alias("m")).join(sizes, "node").where(F.col("m") >= _needed(percent))
    kept = stored(placed.join(often, "node"), "placed")
    hubs = kept.groupBy("sig").agg(F.min("node").alias("hub"), F.max("node").alias("other")).where("hub <> other")
    whole = stored(kept.join(hubs.select("sig", "hub"), "sig").select("sig", "node", "hub", "n", "m"), "lists")
    discard(placed, kept)
    return whole


def _light_boundary(lists: DataFrame) -> int:
    """Classes with fewer shingles than this are light.

    A class in ``m`` lists makes ``m * (m - 1) / 2`` rows of pairs, which its ``m`` rows here share.
    """
    saved = lists.groupBy("n").agg(F.sum(F.lit(2 * ROWS_PER_POSTING) - (F.col("m") - 1)).alias("saved"))
    upto = saved.select("n", F.sum("saved").over(Window.orderBy("n")).alias("total")).where("total > 0")
    best = upto.agg(F.min_by("n", F.struct(-F.col("total"), F.col("n"))).alias("n")).first()["n"]
    return 0 if best is None else int(best) + 1


def candidate_lists(lists: DataFrame) -> DataFrame:
    """(sig, node, hub) after light classes have moved from single shingles to pairs of them; no class is twice in a list."""
    boundary = _light_boundary(lists)
    if not boundary:
        return lists.select("sig", "node", "hub")
    light = F.col("n") < boundary
    heavy = lists.groupBy("sig").agg(F.min(light).alias("only_light")).where("NOT only_light").select("sig")
    scanned = lists.select("sig", "node", "hub").join(heavy, "sig")
    pairs = lists.where(light).groupBy("node").agg(F.array_sort(F.collect_list("sig")).alias("sigs")).select(
        "node", F.explode(F.expr("flatten(transform(sigs, (x, i) -> transform(slice(sigs, i + 2, size(sigs)), y -> xxhash64(x, y))))")).alias("sig")
    )
    hubs = pairs.groupBy("sig").agg(F.min("node").alias("hub"), F.max("node").alias("other")).where("hub <> other")
    return scanned.unionByName(pairs.join(hubs.select("sig", "hub"), "sig").select("sig", "node", "hub"))


def _similar(common, a, b, percent: int):
    return 100 * common >= percent * (a + b - common)


def _tested(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are links."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                good.append(_similar(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    of = lambda side: sets.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("shingles").alias(f"set_{side}"))
    sized = pairs.join(of("a").drop("set_a"), "a").join(of("b").drop("set_b"), "b")
    close = sized.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")).select("a", "b")
    return close.join(of("a"), "a").join(of("b"), "b").select("a", "b", "set_a", "set_b").mapInArrow(test, "a long, b long")


def _block_links(rows: dict, percent: int) -> set[tuple[int, int]]:
    """Links between different components of two blocks, one for each class of the first and component of the other."""
    sides = []
    for side in ("first", "second"):
        members = rows[side]
        sets = [np.frombuffer(m["shingles"], np.uint64) for m in members]
        sides.append((members, sets, np.array([len(s) for s in sets], np.int64), np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])))
    (rest, _, n_rest, tokens, owner), (other, _, n_other, index, index_owner) = sides
    order = np.argsort(index, kind="stable")
    index, index_owner = index[order], index_owner[order]
    low, high = np.searchsorted(index, tokens, "left"), np.searchsorted(index, tokens, "right")
    common = np.zeros(len(rest) * len(other), np.int64)
    ends = np.cumsum(high - low)
    at = 0
    while at < len(tokens):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + MOST_MATCHES, "right")))
        lengths = (high - low)[at:stop]
        places = np.repeat(low[at:stop] - np.r_[0, np.cumsum(lengths)[:-1]], lengths) + np.arange(lengths.sum())
        common += np.bincount(np.repeat(owner[at:stop], lengths) * len(other) + index_owner[places], minlength=len(common))
        at = stop
    common = common.reshape(len(rest), len(other))
    linked = _similar(common, n_rest[:, None], n_other[None, :], percent)
    mine, theirs = np.array([m["comp"] for m in rest]), np.array([m["comp"] for m in other])
    i, j = np.nonzero(linked & (mine[:, None] != theirs[None, :]))
    found = {(rest[a]["node"], int(theirs[b])): other[b]["node"] for a, b in zip(i, j)}
    return {(a, b) for (a, _), b in found.items()}


def _links_between(lists: DataFrame, comps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b), stored, between classes of one list that are not yet in one component.

    ``lists`` and ``sets`` are deleted once they have been read, and so is every table made here: sets take as much room as their texts.
    """
    sizes = stored(comps.groupBy("comp").agg(F.count(F.lit(1)).alias("members")), "component-sizes")
    placed = stored(lists.select("sig", "node").join(comps, "node").join(sizes, "comp"), "placed")
    largest = F.max(F.struct("members", "comp"))
    mixed = placed.groupBy("sig").agg(largest.alias("most"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
    mixed = stored(mixed.select("sig", F.col("most.comp").alias("key")), "mixed")
    roles = placed.join(mixed, "sig").select("key", "node", "comp", (F.col("comp") != F.col("key")).alias("rest")).distinct()
    held = stored(roles.join(sets.select("node", "n", "shingles"), "node"), "held")
    discard(lists, sets, sizes, placed, mixed)
    parts = stored(held.groupBy("key", "rest").agg(F.ceil(F.greatest(F.sum("n") / BLOCK_SHINGLES, F.count(F.lit(1)) / BLOCK_ROWS)).alias("parts")), "parts")
    blocks = held.join(parts, ["key", "rest"]).groupBy("key", "rest", F.pmod(F.xxhash64("node"), F.col("parts")).alias("part"))
    blocks = stored(blocks.agg(F.collect_list(F.struct("node", "comp", "shingles")).alias("members")), "blocks")
    discard(held, parts)
    first = blocks.where("rest").select("key", F.col("part").alias("x"), F.col("members").alias("first"))
    second = blocks.select("key", "rest", F.col("part").alias("y"), F.col("members").alias("second"))
    tiles = first.join(second, "key").where("NOT rest OR x <= y").select("first", "second")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                found = sorted(_block_links({side: batch.column(side)[k].as_py() for side in ("first", "second")}, percent))
                yield pa.RecordBatch.from_arrays([pa.array([p[s] for p in found], pa.int64()) for s in (0, 1)], ["a", "b"])

    found = stored(tiles.mapInArrow(compare, "a long, b long"), "links")
    discard(blocks)
    return found


SET = "node long, n long, shingles binary"


def _rebuilt(wanted: str | None):
    """A task's function from texts to (node, n, shingles), of each row's set or only where it is that of the column ``wanted``."""

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, most_bytes=BLOCK_BYTES):
            sets = [(set_id(s), s) for s in shingle_sets(*utf8_bytes(block.column("text")))]
            if wanted is None:
                sets = list(dict(sets).items())
            else:
                sets = [own for own, node in zip(sets, block.column(wanted).to_pylist()) if own[0] == node]
            yield pa.RecordBatch.from_arrays(
                [pa.array([n for n, _ in sets], pa.int64()), pa.array([len(s) for _, s in sets], pa.int64()), pa.array([s.tobytes() for _, s in sets], pa.binary())],
                ["node", "n", "shingles"],
            )

    return rebuild


def _sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, n, shingles) of the classes ``nodes`` (node, doc_id); a doc_id in several rows may give one twice.

    Texts of a class meet it by the class's doc_id, and only texts that may be wanted are shuffled. Classes of rows that all lack one are
    found among the sets of such rows.
    """
    named = stored(nodes.where("doc_id IS NOT NULL").select("node", F.col("doc_id").alias("named")), "named")
    maybe = flag_wanted(docs.select("doc_id", "text"), "doc_id", named.select(F.col("named").alias("doc_id")), "may_be_wanted").where("may_be_wanted")
    by_id = maybe.join(named, F.col("doc_id") == F.col("named")).select("node", "text").mapInArrow(_rebuilt("node"), SET)
    without = nodes.where("doc_id IS NULL").select("node")
    unnamed = docs.where("doc_id IS NULL").select("text").mapInArrow(_rebuilt(None), SET).join(without, "node", "left_semi")
    return by_id.unionByName(unnamed.dropDuplicates(["node"]))


def similar_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``."""
    caller, docs = docs.sparkSession, tidy(docs.select("doc_id", "text"))
    rows = stored(measured(docs), "measured")
    documents = stored(rows.where("slice IS NULL").select("doc_id", "n", "node"), "documents")
    sketch = _sketch(rows.where("slice IS NOT NULL").select("slice", "counts"))
    discard(rows)
    classes = stored(documents.where("n > 0").groupBy("node").agg(F.min("n").alias("n"), F.min("doc_id").alias("doc_id")), "classes")
    found = stored(_lists(_postings(docs, sketch, percent)), "lists")
    often = _often_listed(found, classes.select("node", "n"), percent)
    lists = stored(candidate_lists(often), "candidates")
    discard(found, often)
    active = stored(lists.select("node").distinct(), "active")
    sets = stored(_sets_of(docs, classes.select("node", "doc_id").join(active, "node")), "sets")
    pairs = stored(lists.where("node <> hub").select(F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b")).distinct(), "pairs")
    links = stored(_tested(pairs, sets, percent), "links")
    found = connected_components(links)
    discard(pairs)
    comps = stored(active.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("comp")), "components")
    more = _links_between(lists, comps, sets, percent)
    # Rows of one doc_id are one document: its classes belong together.
    same = documents.where("n > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("c")).where("b <> c")
    shared = documents.where("n > 0").join(same, "doc_id").select(F.col("node").alias("a"), "b")
    final = connected_components(links.unionByName(more).unionByName(shared))
    labelled = classes.join(final, "node", "left").select("node", "doc_id", F.coalesce("component", "node").alias("component"))
    labels = labelled.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_node = stored(labelled.join(labels, "component").select("node", "component_id"), "labels")
    discard(links, more, comps, active)
    return passed_to(caller, documents).join(passed_to(caller, by_node), "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def drop_similar(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with the document of the smallest doc_id of every component; all columns are kept.

    Rows without doc_id stay, as nothing names them. Only rows that may go are shuffled.
    """
    gone = stored(similar_components(docs, percent).where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    columns = [f"`{c}`" for c in docs.columns]
    flagged = flag_wanted(docs.select(F.struct(*columns).alias("row"), "doc_id"), "doc_id", gone, "may_go")
    stays = flagged.where("may_go").join(gone, "doc_id", "left_anti")
    return flagged.where("NOT may_go").select("row.*").unionByName(stays.select("row.*"))
