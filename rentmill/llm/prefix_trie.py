"""Conversation prefix trie by whole-sequence collapse.

Conversations are sequences of turns, and every distinct sequence of first turns is a node of a trie. Instead of inserting
turns one after the other, whole sequences are collapsed first:

* Identical conversations become one weighted sequence with the list of the conversations that end there. Only one
  representative of a sequence, its smallest conversation, is expanded into prefixes, so copies are never expanded.
* A sequence that is a proper prefix of another one is dropped from the leaves by an anti-join with the inner prefixes.
* Weighted prefixes are added up per node: members, leaves, and the words that sharing the prefixes saves.

Sums over subtrees need no walk over the tree. A node belongs to the sequence of its smallest member, and a sequence owns
its nodes from some depth down to its end, or none; so the sum of a subtree is a sum over the sequences below it of tails of
their running word counts, once per member for all words and once per owner for the words that stay.

Sequences and prefixes are named by two 64-bit lanes, the exclusive or over their turns of hashes of (depth, role, text).
That aggregates in map tasks, so a conversation with a large part of all turns needs no task of its own: its turns are
numbered by a range sort in which each partition numbers its own, and running values are taken in runs of ``RUN`` turns
and shifted by what comes before the run. The turns' texts are shuffled once, for that sort.

Turns are ordered by turn number (null first), then role and text. Null roles and texts are empty. Repeated rows
are repeated turns. Rows without conv_id belong to no conversation and take no part; an empty table gives no node, not
even a root. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rentmill.llm.tables import WORD, stored, text_of

RUN = 1 << 12
IDS_PER_PIECE = 512
NODE = ["depth", "x", "y"]
SEQUENCE = ["n", "x", "y"]


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, a, b, words): every turn's place in its conversation from 0, its content as two hashes, and its words."""
    order = ["conv_id", "turn", "role", "text"]
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", text_of("role").alias("role"), text_of("text").alias("text")
    )
    digest = F.md5(F.concat(F.length("role"), F.lit(":"), F.col("role"), F.col("text")))
    # The partitions come from sampled bounds, so what they number is stored before it is read twice.
    placed = stored(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
            "conv_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"),
            F.xxhash64("role", "text").alias("a"), F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias("b"),
            F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
        ),
        "placed",
    )
    parts = placed.groupBy("conv_id", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    return placed.join(parts, ["conv_id", "part"]).select(
        "conv_id", (F.col("row") - F.col("first") + F.col("before")).alias("at"), "a", "b", "words"
    )


def with_shared_heads(turns: DataFrame, base, head, most: int) -> DataFrame:
    """Turns of conversations whose first ``head`` turns are those of the conversation ``base``, then their own after as many.

    ``base`` and ``head`` are columns over ``conv_id``; ``head`` is at most ``most``. A base that is absent or shorter gives what it has.
    Returns (conv_id, depth, x, y, words) with depths from 1, and per conversation one row of depth 0 that has no words.
    """
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")).select("conv_id", base.alias("base"), head.alias("h"))
    bases = turns.where(F.col("at") < most).groupBy(F.col("conv_id").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("at", "a", "b", "words"))).alias("head")
    )
    nothing = F.array().cast("array<struct<at:bigint,a:bigint,b:bigint,words:bigint>>")
    taken = F.coalesce(F.expr("slice(head, 1, CAST(h AS INT))"), nothing)
    plan = stored(convs.join(bases, "base", "left").select("conv_id", "h", taken.alias("taken")), "heads")
    first = plan.select("conv_id", F.explode("taken").alias("t")).select("conv_id", (F.col("t.at") + 1).alias("depth"), "t.a", "t.b", "t.words")
    shifts = plan.select("conv_id", "h", (F.size("taken") + 1 - F.col("h")).alias("shift"))
    rest = turns.join(shifts, "conv_id").where("at >= h").select("conv_id", (F.col("at") + F.col("shift")).alias("depth"), "a", "b", "words")
    lanes = [F.xxhash64("depth", "a", "b").alias("x"), F.xxhash64(F.lit("second"), "b", "depth", "a").alias("y")]
    zero = F.lit(0).cast("long")
    roots = plan.select("conv_id", zero.alias("depth"), zero.alias("x"), zero.alias("y"), zero.alias("words"))
    return first.unionByName(rest).select("conv_id", "depth", *lanes, "words").unionByName(roots)


def members(turns: DataFrame) -> DataFrame:
    """(conv_id, n, x, y, total): the sequence of every conversation by length and name, and its words."""
    return turns.groupBy("conv_id").agg(
        F.max("depth").alias("n"), F.expr("bit_xor(x)").alias("x"), F.expr("bit_xor(y)").alias("y"), F.sum("words").alias("total")
    )


def weighted_sequences(ended: DataFrame) -> DataFrame:
    """(n, x, y, weight, conv_id, total): identical conversations as one sequence of their smallest one."""
    return ended.groupBy(*SEQUENCE).agg(
        F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("conv_id"), F.min("total").alias("total")
    )


def prefixes(turns: DataFrame, sequences: DataFrame) -> DataFrame:
    """A row per sequence and depth: the prefix (depth, x, y), the one before it (up_x, up_y) and the words before its last turn."""
    own = turns.join(sequences.select("conv_id", "n", "weight"), "conv_id").withColumn("run", F.expr(f"depth div {RUN}"))
    own = stored(own, "representatives")
    upto = Window.partitionBy("conv_id", "run").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sums = {"x": "bit_xor(x)", "y": "bit_xor(y)", "words": "sum(words)"}
    runs = own.where(F.col("n") >= RUN).groupBy("conv_id", "run").agg(*(F.expr(e).alias(c) for c, e in sums.items()))
    shifts = runs.select("conv_id", "run", *(F.expr(e).over(earlier).alias(f"past_{c}") for c, e in sums.items())).where("run > 0")
    within = own.select("*", *(F.expr(e).over(upto).alias(f"in_{c}") for c, e in sums.items())).join(shifts, ["conv_id", "run"], "left")

    def shifted(lane: str):
        return F.col(f"in_{lane}").bitwiseXOR(F.coalesce(f"past_{lane}", F.lit(0)))

    return within.select(
        "conv_id", "depth", shifted("x").alias("x"), shifted("y").alias("y"), shifted("x").bitwiseXOR(F.col("x")).alias("up_x"),
        shifted("y").bitwiseXOR(F.col("y")).alias("up_y"), "n", "weight",
        (F.col("in_words") - F.col("words") + F.coalesce("past_words", F.lit(0))).alias("before"),
    )


def ends_digests(ended: DataFrame) -> DataFrame:
    """(n, x, y, ends_sha256): the digest of the ascending decimal conv_ids of every sequence, joined by commas.

    A range sort spreads the ids of a large group over tasks, which write them out in pieces; the digest, which has
    to be taken in order, reads the pieces as a stream.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, x, y, ids = (batch.column(c).to_numpy() for c in (*SEQUENCE, "conv_id"))
            edge = np.r_[True, (n[1:] != n[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])] if len(ids) else np.zeros(0, bool)
            firsts = np.flatnonzero(edge)
            starts = np.unique(np.concatenate([firsts, *(np.arange(f, e, IDS_PER_PIECE) for f, e in zip(firsts, [*firsts[1:], len(ids)]))])) if len(ids) else firsts
            ends = [*starts[1:], len(ids)]
            pieces = [",".join(map(str, ids[s:e].tolist())) for s, e in zip(starts, ends)]
            yield pa.RecordBatch.from_arrays([pa.array(c[starts]) for c in (n, x, y, ids)] + [pa.array(pieces, pa.string())], [*SEQUENCE, "conv_id", "piece"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, running = None, None
        for batch in batches:
            done = []
            for *key, piece in zip(*(batch.column(c).to_pylist() for c in (*SEQUENCE, "piece"))):
                if key == name:
                    running.update(b",")
                else:
                    if name is not None:
                        done.append((*name, running.hexdigest()))
                    name, running = key, hashlib.sha256()
                running.update(piece.encode())
            yield _rows(done)
        if name is not None:
            yield _rows([(*name, running.hexdigest())])

    def _rows(done: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate(kinds)], [*SEQUENCE, "ends_sha256"])

    key = "n long, x long, y long"
    order = [*SEQUENCE, "conv_id"]
    pieces = ended.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(write, f"{key}, conv_id long, piece string")
    return pieces.repartition(*SEQUENCE).sortWithinPartitions(*order).mapInArrow(digest, f"{key}, ends_sha256 string")


def trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv_id, depth, x, y, words; a row of depth 0 per conversation).

    A node is named by ``conv_id``, its smallest member, and ``depth``: it is the first ``depth`` turns of that conversation.
    """
    turns = stored(turns, "turns")
    ended = stored(members(turns), "members")
    sequences = stored(weighted_sequences(ended), "sequences")
    rows = stored(prefixes(turns, sequences.drop("x", "y")), "prefixes")
    nodes = stored(
        rows.groupBy(*NODE).agg(
            F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.max("n").alias("deepest"),
            F.min("up_x").alias("up_x"), F.min("up_y").alias("up_y"), F.min("before").alias("before"),
        ),
        "nodes",
    )
    inner = nodes.where("deepest > depth").select(F.col("depth").alias("n"), "x", "y")
    leaves = sequences.join(inner, SEQUENCE, "left_anti").select("conv_id", F.lit(1).cast("long").alias("leaf"))
    owned = nodes.groupBy("conv_id").agg(F.min("depth").alias("owned_from"), F.min_by("before", "depth").alias("owned_before"))
    about = stored(
        sequences.select("conv_id", "total").join(owned, "conv_id", "left").join(leaves, "conv_id", "left").select(
            "conv_id", "owned_from", F.coalesce("leaf", F.lit(0)).alias("leaf"), "total",
            F.coalesce(F.col("total") - F.col("owned_before"), F.lit(0)).alias("owned_tail"),
        ),
        "owners",
    )
    tail = F.col("total") - F.col("before")
    kept_once = F.when(F.col("depth") >= F.col("owned_from"), tail).otherwise(F.col("owned_tail"))
    sums = rows.select("conv_id", *NODE, "weight", "before").join(about, "conv_id").groupBy(*NODE).agg(
        F.sum("leaf").alias("n_leaves"), F.sum(F.col("weight") * tail - kept_once).alias("saved_tokens")
    )
    up = [(F.col("depth") - 1).alias("depth"), F.col("up_x").alias("x"), F.col("up_y").alias("y")]
    children = nodes.where("depth > 0").select(*up).groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x").alias("up_x"), F.col("y").alias("up_y"), F.col("conv_id").alias("parent_conv_id"))
    digests = ends_digests(ended).withColumnRenamed("n", "depth")
    whole = nodes.join(sums, NODE).join(children, NODE, "left").join(digests, NODE, "left")
    return whole.join(parents, ["depth", "up_x", "up_y"], "left").select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
