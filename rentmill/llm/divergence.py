"""Source divergence audit: how far the term distributions of a language's sources lie apart, from a frequent-pattern tree.

Every source of a language gives each kept term a smoothed share ``p`` in whole billionths. Two sources differ by the sum of
``abs(p - q)`` over all kept terms, also those that neither of them has. A term that a source does not have gets the source's
floor ``z``, so all pairs start from ``V * abs(z - z')`` and only nonzero counts correct that:

* A term row is a language's term with its nonzero counts, ordered by source. Equal rows become one with a multiplicity, and the
  rows are inserted into a frequent-pattern tree as paths of (source, p). A node's multiplicity is that of all rows that pass it.
  Terms that two sources both have are then corrected once per node and ancestor instead of once per term.
* Terms that one of two sources has are corrected from the source's histogram of ``p`` alone, by binary search among its sums.

The rows are sorted by path over all tasks, so shared paths are neighbours and a task holds only the branch it is
at: a node is complete, and its corrections are made, when the next row leaves it. A path that spans two tasks is two
branches whose corrections add up. Corrections are summed per pair of sources in the task, and sent on when
``MOST_SUMS`` pairs have gathered.

Terms are counted per block of documents in the tasks and combined before the shuffle, which is by (language, term); no task
sees more of a source than its terms' counts. A row of the tree has at most one entry per source of the language, and the
result has a row per ordered pair of sources, which the contract asks for; nothing else grows with pairs.

Null text, language and source are empty. Each row of the table is a document, also where doc_id repeats or is null. A
language without kept terms has pairs of value 0 and no terms; one with a single source has no pairs. An empty table
gives an empty result. Other columns are ignored, whatever their names. All arithmetic is on whole numbers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentmill.llm.tables import stored, text_of

LEAST_DOCUMENTS = 30
MOST_TERMS = 50
SCALE, SMOOTHING = 1_000_000_000, 5

# Letters A-Z and everything beyond ASCII, in lower-cased UTF-8.
TERM = re.compile(rb"[a-z\x80-\xff]+")
STRETCH_BYTES = 1 << 20
MOST_COUNTED = 1 << 18
MOST_SUMS = 1 << 21


def stretches(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a bounded stretch of it at a time."""
    start = 0
    while start < len(data):
        stop = start + STRETCH_BYTES
        if stop < len(data):  # not within a term
            rest = TERM.match(data, stop)
            stop = rest.end() if rest else stop
        yield TERM.findall(data, start, stop)
        start = stop


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of terms and documents with them, summed per block of a task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("lang", "source")]
            for *group, text in zip(*columns, batch.column("text")):
                n, seen = counts.setdefault(tuple(group), (Counter(), Counter()))
                before, own = len(n), set()
                for terms in stretches(text.as_py().lower()):
                    n.update(terms)
                    own.update(terms)
                seen.update(own)
                held += len(n) - before
                if held > MOST_COUNTED:
                    yield from emptied(counts)
                    held = 0
        yield from emptied(counts)

    def emptied(counts: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, seen) in counts.items():
            terms = [t.decode() for t in n]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()), pa.array(terms, pa.string()),
                 pa.array(list(n.values()), pa.int64()), pa.array([seen[t] for t in n], pa.int64())],
                ["lang", "source", "term", "n", "docs"],
            )
        counts.clear()

    texts = docs.select(text_of("lang").alias("lang"), text_of("source").alias("source"), F.encode(text_of(), "UTF-8").alias("text"))
    return texts.mapInArrow(count, "lang string, source string, term string, n long, docs long")


def kept_counts(docs: DataFrame, least_documents: int) -> DataFrame:
    """(lang, term, source, n, lang_n, first) of terms in enough documents of the language; ``first`` marks one row per term."""
    term = Window.partitionBy("lang", "term")
    counts = term_counts(docs).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    judged = counts.select(
        "lang", "term", "source", "n", F.sum("n").over(term).alias("lang_n"), F.sum("docs").over(term).alias("lang_docs"),
        (F.row_number().over(term.orderBy("source")) == 1).cast("long").alias("first"),
    )
    return judged.where(F.col("lang_docs") >= least_documents).drop("lang_docs")


def share(n, total, terms) -> Column:
    """The smoothed share of ``n`` in ``total``, in whole billionths and at least 1; exact for any counts."""
    over = (F.lit(SCALE).cast("decimal(10,0)") * (n + F.lit(SMOOTHING)).cast("decimal(20,0)"))
    under = (total + F.lit(SMOOTHING) * terms).cast("decimal(20,0)")
    return F.call_function("div", over, under) + 1


def source_table(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, source, k, total, lang_total, v, z) of every group: its number in the language, sums, kept terms and floor."""
    groups = docs.select(text_of("lang").alias("lang"), text_of("source").alias("source")).distinct()
    groups = groups.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long"))
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = counts.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.sum("first").alias("v"))
    zero = F.lit(0).cast("long")
    whole = groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", "k", *(F.coalesce(c, zero).alias(c) for c in ("total", "lang_total", "v"))
    )
    return whole.withColumn("z", F.when(F.col("v") > 0, share(zero, F.col("total"), F.col("v"))).otherwise(zero))


def _pair_batch(lang: list, low: list, high: list, value: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(lang, pa.string()), *(pa.array(x, pa.int64()) for x in (low, high, value))], ["lang", "low", "high", "value"]
    )


class Branch:
    """The branch of the tree that is open, as arrays from the root down, and the corrections of what was closed."""

    def __init__(self) -> None:
        self.lang, self.depth, self.sums, self.held = None, 0, {}, 0
        self.entries, self.rows = np.zeros((64, 3), np.int64), np.zeros(64, np.int64)

    def insert(self, path: np.ndarray, rows: int) -> None:
        """Add ``rows`` equal rows with the entries (k, p, z), closing the nodes they leave."""
        common = min(self.depth, len(path))
        unlike = np.flatnonzero((self.entries[:common] != path[:common]).any(axis=1))
        shared = int(unlike[0]) if len(unlike) else common
        self.close(shared)
        if len(path) > len(self.entries):
            more = max(len(path), 2 * len(self.entries))
            self.entries, self.rows = np.resize(self.entries, (more, 3)), np.resize(self.rows, more)
        self.entries[shared : len(path)] = path[shared:]
        self.rows[shared : len(path)] = 0
        self.depth = len(path)
        self.rows[self.depth - 1] += rows

    def close(self, depth: int) -> None:
        """Close all nodes from ``depth`` on: each adds its corrections with its ancestors, and its rows to its parent."""
        for at in range(self.depth - 1, depth - 1, -1):
            rows, (k, p, z) = self.rows[at], self.entries[at]
            if at:
                self.rows[at - 1] += rows
                up, q, y = self.entries[:at].T
                change = np.abs(p - q) + np.abs(z - y) - np.abs(p - y) - np.abs(q - z)
                mine = self.sums.get(int(k))
                if mine is None:  # entries are in the order of k, so all ancestors' numbers are smaller
                    mine = self.sums[int(k)] = np.zeros(int(k), np.int64)
                    self.held += int(k)
                mine[up] += rows * change
        self.depth = depth

    def taken(self) -> pa.RecordBatch:
        low, high, value = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k, sums in self.sums.items():
            some = np.flatnonzero(sums)
            low.append(some)
            high.append(np.full(len(some), k))
            value.append(sums[some])
        low, high, value = (np.concatenate(x) for x in (low, high, value))
        self.sums, self.held = {}, 0
        return _pair_batch([self.lang] * len(low), low, high, value)


def shared_term_corrections(paths: DataFrame) -> DataFrame:
    """(lang, low, high, value): the corrections of terms that two sources both have, from the tree of ``paths`` (lang, path, rows)."""

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        branch = Branch()
        for batch in batches:
            column = batch.column("path")
            flat = column.values.to_numpy(zero_copy_only=False)
            offsets = column.offsets.to_numpy()
            for at, (lang, rows) in enumerate(zip(batch.column("lang").to_pylist(), batch.column("rows").to_pylist())):
                if lang != branch.lang:
                    branch.close(0)
                    yield branch.taken()
                    branch.lang = lang
                branch.insert(flat[offsets[at] : offsets[at + 1]].reshape(-1, 3), rows)
                if branch.held > MOST_SUMS:
                    yield branch.taken()
        branch.close(0)
        yield branch.taken()

    placed = paths.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
    return placed.mapInArrow(grow, "lang string, low long, high long, value long")


def own_term_corrections(histogram: DataFrame, pairs: DataFrame) -> DataFrame:
    """(lang, low, high, value): for every ordered pair (k, other) of sources, the corrections of terms that ``k`` has.

    ``histogram`` has (lang, k, p, rows), ``pairs`` has (lang, k, other, z, y): the floors of ``k`` and of ``other``.
    """

    def correct(own: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("p")
        p, rows = own["p"].to_numpy(np.int64), own["rows"].to_numpy(np.int64)
        y, z = pairs["y"].to_numpy(np.int64), pairs["z"].to_numpy(np.int64)
        number, mass = np.r_[0, np.cumsum(rows)], np.r_[0, np.cumsum(rows * p)]
        below = np.searchsorted(p, y)
        apart = (mass[-1] - 2 * mass[below]) - y * (number[-1] - 2 * number[below])
        k, other = pairs["k"].to_numpy(np.int64), pairs["other"].to_numpy(np.int64)
        value = apart - number[-1] * np.abs(z - y)
        return pd.DataFrame({"lang": pairs["lang"], "low": np.minimum(k, other), "high": np.maximum(k, other), "value": value})

    return histogram.groupBy("lang", "k").cogroup(pairs.groupBy("lang", "k")).applyInPandas(correct, "lang string, low long, high long, value long")


def source_distances(shares: DataFrame, sources: DataFrame) -> DataFrame:
    """(lang, low, high, value): the summed difference of every two sources of a language, by their numbers.

    ``shares`` has (lang, term, k, p, z) for every nonzero count.
    """
    entries = F.array_sort(F.collect_list(F.struct("k", "p", "z")))
    rows = shares.groupBy("lang", "term").agg(F.flatten(F.transform(entries, lambda e: F.array(e["k"], e["p"], e["z"]))).alias("path"))
    paths = stored(rows.groupBy("lang", "path").agg(F.count(F.lit(1)).alias("rows")), "paths")
    histogram = shares.groupBy("lang", "k", "p").agg(F.count(F.lit(1)).alias("rows"))
    mine = sources.select("lang", "k", "z", "v")
    other = sources.select("lang", F.col("k").alias("other"), F.col("z").alias("y"))
    pairs = stored(mine.join(other, "lang").where(F.col("k") != F.col("other")), "pairs")
    floors = pairs.where(F.col("k") < F.col("other")).select(
        "lang", F.col("k").alias("low"), F.col("other").alias("high"), (F.col("v") * F.abs(F.col("z") - F.col("y"))).alias("value")
    )
    # A source without kept terms has no histogram, and nothing to correct.
    own = own_term_corrections(histogram, pairs.drop("v").join(histogram.select("lang", "k").distinct(), ["lang", "k"], "left_semi"))
    parts = floors.unionByName(own).unionByName(shared_term_corrections(paths))
    return parts.groupBy("lang", "low", "high").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, most_terms: int | None = MOST_TERMS) -> DataFrame:
    """lang, source, part, item, value and rank of every source of every language.

    Part ``pair`` holds the difference from each other source of the language; part ``term`` the ``most_terms`` terms (None:
    all) that the source uses more than its language does, with the difference of the shares.
    """
    counts = stored(kept_counts(docs, least_documents), "counts")
    sources = stored(source_table(docs, counts), "sources")
    sized = counts.join(sources, ["lang", "source"])
    own, whole = share(F.col("n"), F.col("total"), F.col("v")), share(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    shares = stored(sized.select("lang", "term", "source", "k", own.alias("p"), "z", whole.alias("q")), "shares")
    distances = stored(source_distances(shares, sources), "distances")
    ways = [distances.select("lang", F.col(a).alias("k"), F.col(b).alias("other"), "value") for a, b in (("low", "high"), ("high", "low"))]
    named = sources.select("lang", "k", "source")
    pairs = ways[0].unionByName(ways[1]).join(named, ["lang", "k"]).join(
        named.select("lang", F.col("k").alias("other"), F.col("source").alias("item")), ["lang", "other"]
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(order))
    if most_terms is not None:
        terms = terms.where(F.col("rank") <= most_terms)
    pairs = pairs.select("lang", "source", "item", "value").withColumn("rank", F.row_number().over(order))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(columns).unionByName(terms.withColumn("part", F.lit("term")).select(columns))
