"""Mixing sources to target weights by entropy balancing.

Each document gets a rate, the number of times the mix takes it before rounding. Among all rates of at most
``most`` that meet the token constraint of every source, the rates closest to 1 in relative entropy are
``min(most, exp(lambda_s * size / scale_s))``: each source has one multiplier, found by Newton iterations on the
convex dual. Every iteration is one aggregation over a histogram (source, size), which has the same sums as the
documents; a bracket around each root catches steps that leave it. Sources are rows of a table, not columns or driver state.

Targets: sources sorted by code point, null last, weigh 1, 2, 3, repeating, and share the size of the whole input. A
target stops at ``most`` times its source's size; what is over is shared again by weight until none is above, which
is a water level over the sources sorted by size per weight.

Rounding: within a source the expected copies are accumulated by size and rounded, so the error in tokens stays
under one largest document. What is missing is then added or removed in copies, as many as fit from the largest size down, and
where none fits in one copy of the size that brings the source closest, until no copy brings it closer.
Documents of one source and size are told apart by a hash of the id, in slices of about ``SLICE_ROWS`` where they are many, so
that no source or size is ranked in one task. Running sums go over a source's distinct sizes and slices.

Null texts have size 0; documents of size 0 are taken once and change nothing. Equal documents with one doc_id may
trade copies among each other; sums are the same. The same input gives the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentmill.llm.tables import WORD, stored, text_of

MOST = 3
SLICE_ROWS = 1 << 20
MOST_ITERATIONS = 60
TOLERANCE = 1e-9
CELL = ["source", "size", "slice", "docs", "source_size", "target", "rate", "copies"]


def sized(docs: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """doc_id, source, size in words, and the slice of the document's id among those of its source and size.

    Only a source and size of more than ``slice_rows`` documents has several slices, as many as keep each at about that number. At most
    rows / ``slice_rows`` sources and sizes are that common, so the list of them is short.
    """
    sizes = stored(docs.select("doc_id", "source", F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size")), "sizes")
    slices = F.ceil(F.count(F.lit(1)) / slice_rows).alias("slices")
    common = sizes.groupBy(F.col("source").alias("common_source"), F.col("size").alias("common_size")).agg(slices).where("slices > 1")
    same = F.col("source").eqNullSafe(F.col("common_source")) & (F.col("size") == F.col("common_size"))
    slice_of = F.when(F.col("slices").isNotNull(), F.pmod(F.xxhash64("doc_id"), F.col("slices"))).otherwise(0)
    return sizes.join(common, same, "left").select("doc_id", "source", "size", slice_of.alias("slice"))


def source_targets(cells: DataFrame, most: float = MOST) -> DataFrame:
    """source, source_size and target. The windows run over one row per source."""
    by_source = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    ranked = by_source.select("*", ((F.row_number().over(order) - 1) % 3 + 1).alias("weight"))
    # Sources fill up in the order of their cap per weight; the level is set by the first that does not fill up.
    by_cap = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    all_rows = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("source_size").over(all_rows) - F.coalesce(F.sum(most * F.col("source_size")).over(before), F.lit(0))
    weights = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levelled = ranked.select("*", (rest / weights).alias("level"))
    fits = F.when(
        F.col("level") * F.col("weight") <= most * F.col("source_size"),
        F.struct((F.col("source_size") / F.col("weight")).alias("cap"), F.col("source").isNull().alias("last"), "source", "level"),
    )
    open_level = F.min(fits).over(Window.partitionBy(F.lit(1)))["level"]
    target = F.least(F.coalesce(open_level * F.col("weight"), F.lit(float("inf"))), (most * F.col("source_size")).cast("double"))
    return levelled.select("source", "source_size", target.alias("target"))


def _rate(most: float) -> Column:
    """The tilted rate of a size under the multiplier ``tilt`` of its source."""
    tilted = F.least(F.lit(float(most)), F.exp(F.col("tilt") * F.col("size") / F.col("scale")))
    return F.when(F.col("target") >= most * F.col("source_size"), float(most)).otherwise(tilted)


def solve_tilts(cells: DataFrame, targets: DataFrame, most: float = MOST) -> DataFrame:
    """``targets`` with each source's multiplier ``tilt`` and size unit ``scale``."""
    tokens = F.col("size") * F.col("docs")
    shape = cells.where("size > 0").groupBy("source").agg(
        (F.sum(tokens * F.col("size")) / F.sum(tokens)).alias("scale"), F.min("size").alias("least")
    )
    same = targets["source"].eqNullSafe(shape["source"])
    # At ``low`` no size is above its share and at ``high`` every size is at the cap: the root lies between.
    state = targets.join(shape, same, "left").drop(shape["source"]).select(
        "source", "source_size", "target", F.coalesce("scale", F.lit(1.0)).alias("scale"),
        F.coalesce(F.log(F.least(F.lit(1.0), F.col("target") / F.col("source_size"))) * F.col("scale") / F.col("least"), F.lit(0.0)).alias("low"),
        F.coalesce(F.log(F.lit(float(most))) * F.col("scale") / F.col("least"), F.lit(0.0)).alias("high"),
        F.lit(0.0).alias("tilt"), F.lit(False).alias("done"),
    )
    state = stored(state, "tilts")
    for _ in range(MOST_ITERATIONS):
        joined = cells.join(state, cells["source"].eqNullSafe(state["source"])).drop(cells["source"])
        rate = _rate(most)
        slope = F.when(rate < most, tokens * rate * F.col("size") / F.col("scale")).otherwise(0.0)
        moments = joined.groupBy(state.columns).agg(F.sum(tokens * rate).alias("mass"), F.sum(slope).alias("slope"))
        gap = F.col("mass") - F.col("target")
        low = F.when(gap < 0, F.greatest("low", "tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.least("high", "tilt")).otherwise(F.col("high"))
        newton = F.when(F.col("slope") > 0, F.col("tilt") - gap / F.col("slope"))
        inside = (newton > low) & (newton < high)
        done = (F.abs(gap) <= TOLERANCE * F.col("target")) | (F.col("target") >= most * F.col("source_size"))
        step = F.when(done, F.col("tilt")).when(inside, newton).otherwise((low + high) / 2)
        state = stored(
            moments.select("source", "source_size", "target", "scale", low.alias("low"), high.alias("high"), step.alias("tilt"), done.alias("done")),
            "tilts",
        )
        if state.where("NOT done").isEmpty():
            break
    # Rounded far above the solver's error, so that another order of summing cannot change what follows.
    return state.select("source", "source_size", "target", "scale", F.round("tilt", 9).alias("tilt"))


def _corrected(cells: DataFrame, most: int) -> DataFrame:
    """``cells`` with copies nearer to each source's target, and whether a cell's number has ``moved``.

    Copies that fit what is missing are changed first, as many as there are, from the largest size down. A source in which none
    fits changes one copy of the size that brings it closest, if that is closer.
    """
    same = Window.partitionBy("source")
    before = same.orderBy(F.col("size").desc(), "slice").rowsBetween(Window.unboundedPreceding, -1)
    missing = F.col("target") - F.sum(F.col("copies") * F.col("size")).over(same)
    wanted = cells.select(*CELL, missing.alias("missing")).select(
        "*", F.abs(F.abs("missing") - F.col("size")).alias("left"),
        F.when(F.col("missing") > 0, most * F.col("docs") - F.col("copies")).otherwise(F.col("copies")).alias("free"),
    )
    fits = F.when((F.col("size") > 0) & (F.col("size") <= F.abs("missing")), F.col("free")).otherwise(0)
    rest = F.abs("missing") - F.coalesce(F.sum(fits * F.col("size")).over(before), F.lit(0))
    many = F.when(fits > 0, F.greatest(F.lit(0), F.least(fits, F.floor(rest / F.col("size"))))).otherwise(0)
    offer = F.when((F.col("free") > 0) & (F.col("left") < F.abs("missing") - TOLERANCE), F.struct("left", "size", "slice"))
    filled = wanted.select("*", many.cast("long").alias("many"), offer.alias("offer"))
    one = F.coalesce(F.col("offer") == F.min("offer").over(same), F.lit(False)).cast("long")
    step = F.when(F.sum("many").over(same) > 0, F.col("many")).otherwise(one)
    stepped = filled.select("*", step.alias("step"))
    return stepped.withColumn("copies", F.col("copies") + F.signum("missing").cast("long") * F.col("step")).select(*CELL, (F.col("step") > 0).alias("moved"))


def mix(docs: DataFrame, most: int = MOST, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """doc_id, size, source_size, target, taken, source, rate and copies of every document."""
    sizes = stored(sized(docs, slice_rows), "slices")
    cells = stored(sizes.groupBy("source", "size", "slice").agg(F.count(F.lit(1)).alias("docs")), "cells")
    histogram = stored(cells.groupBy("source", "size").agg(F.sum("docs").alias("docs")), "histogram")
    targets = stored(source_targets(histogram, most), "targets")
    tilts = solve_tilts(histogram, targets, most)
    rated = cells.join(tilts, cells["source"].eqNullSafe(tilts["source"])).drop(tilts["source"])
    rated = rated.select("*", F.when(F.col("size") == 0, 1.0).otherwise(_rate(most)).alias("rate"))
    upto = Window.partitionBy("source").orderBy("size", "slice").rowsBetween(Window.unboundedPreceding, 0)
    # Rounding at a fixed place of every source: what is taken is the step between two rounded running sums.
    running = F.round(F.sum(F.col("rate") * F.col("docs")).over(upto), 6)
    rounded = rated.select("*", F.floor(running + 0.5).alias("upto")).select(
        "*", (F.col("upto") - F.coalesce(F.lag("upto").over(Window.partitionBy("source").orderBy("size", "slice")), F.lit(0))).alias("copies")
    ).drop("upto")
    rounded = rounded.withColumn("copies", F.least(F.col("copies"), most * F.col("docs")))
    plan = stored(rounded.select(*CELL, F.lit(True).alias("moved")), "copies")
    while not plan.where("moved").isEmpty():
        plan = stored(_corrected(plan, most), "copies")
    plan = plan.select(CELL)
    key = [sizes[c].eqNullSafe(plan[c]) if c == "source" else sizes[c] == plan[c] for c in ("source", "size", "slice")]
    planned = sizes.join(plan, key[0] & key[1] & key[2]).drop(plan["source"], plan["size"], plan["slice"])
    place = F.row_number().over(Window.partitionBy("source", "size", "slice").orderBy(F.xxhash64("doc_id", F.lit("copy")), "doc_id"))
    share = F.floor(F.col("copies") / F.col("docs"))
    copies = (share + (place <= F.col("copies") - share * F.col("docs")).cast("long")).cast("long")
    return planned.select(
        "doc_id", "size", "source_size", "target", "source", "rate", copies.alias("own"),
    ).select("doc_id", "size", "source_size", "target", (F.col("own") * F.col("size")).alias("taken"), "source", "rate", F.col("own").alias("copies"))


def take_copies(docs: DataFrame, most: int = MOST) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; rows that share a doc_id as often as the first of them."""
    copies = mix(docs, most).groupBy("doc_id").agg(F.max("copies").alias("copies")).where("copies > 0")
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    joined = whole.join(copies, F.col("row.doc_id").eqNullSafe(copies["doc_id"]))
    return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
