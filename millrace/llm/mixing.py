"""Mixing sources to target weights by entropy balancing; DataFrame functions only.

Each source has a token target. Among all document rates that meet the targets, entropy balancing
takes those nearest to the base rates (1 each) in relative entropy; they are exponentially tilted,
``rate = exp(lambda[source])``, and ``lambda`` solves the convex dual

    minimise  sum over sources of  size[s] * exp(lambda[s]) - target[s] * lambda[s].

There is one constraint per source, so the Hessian is diagonal and each Newton step updates every
source on its own, in the table of sources, which Spark partitions.

Rounding into copies: documents of one source and size are interchangeable, so everything is decided
on cells (source, size). A rate r gives every document floor(r) copies; the
fraction goes to floor(f * N + 1/2) of the first N documents, from the largest size down; what then
still differs from the target is moved on the smallest documents, one copy each, so a source ends
within the size of one small document wherever its copies allow it. A hot source or a hot size is
never one group: sizes split it, and ids split a size into slices.

Defined results: null and empty texts have size 0; they follow their source's rate and take nothing.
A null source is a source of its own, the last. Targets of empty sources are 0. Repeated rows are
documents of their own; ties are broken by id, then slice order; very long texts are counted whole; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import WORD, stored

WEIGHTS = (5, 2, 1)
MOST = 3  # copies of a document, and target over size of a source
SLICES = 64  # by id, of the documents of one source and size
NEWTON_STEPS = 60
DIGITS = 12  # to which a solved rate is exact


def sizes(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target): shares of the whole by weight, capped, the excess reshared.

    Resharing ends at one level: target = min(most * size, weight * level). Sources whose cap per weight
    lies below the level are capped; sorted by it, running sums give the level. One row per source.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    ranked = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    ranked = ranked.withColumn("cap", most * F.col("source_size"))
    rising = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    done = rising.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(done), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(done), F.lit(0))
    )
    leveled = ranked.withColumn("_level", level)
    # The first source in this order that stays below its cap fixes the level for all after it.
    free = F.min(F.when(F.col("_level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("_level").alias("level")))).over(everything)
    return leveled.withColumn("_free", free["level"]).select(
        "source",
        "source_size",
        F.least(F.col("cap").cast("double"), F.coalesce(F.col("weight") * F.col("_free"), F.col("cap").cast("double"))).alias("target"),
    )


def newton_rate(size: Column, target: Column, steps: int = NEWTON_STEPS) -> Column:
    """exp(lambda) at the dual's minimum, from lambda = 0; steps are damped to at most 1 upwards.

    gradient = size * exp(lambda) - target, Hessian = size * exp(lambda).
    """
    step = lambda lam: F.least(F.lit(1.0), target / (size * F.exp(lam)) - 1)
    solved = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.lit(0.0), lambda lam, _: lam + F.greatest(F.lit(-1.0), step(lam)))
    return F.when((size > 0) & (target > 0), F.round(F.exp(solved), DIGITS)).otherwise(F.lit(0.0))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies, rate, source) per document."""
    sized = stored(
        sizes(docs).withColumn("slice", F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(SLICES)).cast("int")), "mix-sizes"
    )
    slices = sized.groupBy("source", "size", "slice").agg(F.count("*").alias("n"))
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    solved = targets(totals, weights, most).withColumn("rate", newton_rate(F.col("source_size"), F.col("target")))
    solved = stored(solved, "mix-rates")
    cells = round_cells(slices.groupBy("source", "size").agg(F.sum("n").alias("n")), solved, most)
    # Within a size, the slices fill up in order.
    cell = (F.col("d.source").eqNullSafe(F.col("c.source"))) & (F.col("d.size") == F.col("c.size"))
    before = F.coalesce(F.sum("d.n").over(W.partitionBy("d.source", "d.size").orderBy("d.slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    plan = slices.alias("d").join(cells.alias("c"), cell).select(
        "d.source", "d.size", "d.slice", "c.source_size", "c.target", "c.rate", "c.base",
        F.greatest(F.lit(0), F.col("c.extra") - before).alias("extra"),
    )
    plan = stored(plan, "mix-cells")
    place = F.row_number().over(W.partitionBy("source", "size", "slice").orderBy("doc_id"))
    ranked = sized.withColumn("_place", place)
    # Cells compress far below their size in memory, so their files' size must not suggest a broadcast.
    joined = ranked.alias("d").join(plan.alias("c").hint("merge"), cell & (F.col("d.slice") == F.col("c.slice")))
    copies = F.col("c.base") + F.when(F.col("_place") <= F.col("c.extra"), 1).otherwise(0)
    return joined.select(
        "d.doc_id", "d.size", "c.source_size", "c.target", (copies * F.col("d.size")).cast("long").alias("taken"),
        copies.cast("int").alias("copies"), "c.rate", "d.source",
    )


def round_cells(cells: DataFrame, solved: DataFrame, most: int) -> DataFrame:
    """(source, size, base, extra): each of the cell's ``n`` documents gets ``base`` copies, ``extra`` of them one more."""
    joined = cells.alias("a").join(solved.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))).select("a.*", "b.source_size", "b.target", "b.rate")
    joined = joined.withColumn("base", F.floor("rate")).withColumn("frac", F.col("rate") - F.floor("rate"))
    falling = W.partitionBy("source").orderBy(F.col("size").desc())
    upto = F.sum("n").over(falling.rowsBetween(W.unboundedPreceding, 0))
    whole = lambda count: F.floor(F.col("frac") * count + 0.5)
    first = joined.withColumn("_upto", upto).withColumn("extra", whole(F.col("_upto")) - whole(F.col("_upto") - F.col("n")))
    first = first.withColumn("extra", F.when(F.col("base") >= most, 0).otherwise(F.col("extra")))
    source = W.partitionBy("source")
    taken = F.sum((F.col("base") * F.col("n") + F.col("extra")) * F.col("size")).over(source)
    first = first.withColumn("_left", F.col("target") - taken)
    rising = W.partitionBy("source").orderBy("size").rowsBetween(W.unboundedPreceding, -1)
    room = F.when(F.col("_left") >= 0, F.when(F.col("base") >= most, 0).otherwise(F.col("n") - F.col("extra"))).otherwise(F.col("extra"))
    first = first.withColumn("_room", F.when(F.col("size") > 0, room).otherwise(0))
    before = F.coalesce(F.sum(F.col("_room") * F.col("size")).over(rising), F.lit(0))
    open_ = F.greatest(F.lit(0), F.abs("_left") - before)
    moved = F.least(F.col("_room"), F.floor(open_ / F.greatest(F.col("size"), F.lit(1))))
    return first.withColumn("_moved", moved).select(
        "source", "size", "source_size", "target", "rate", "base",
        (F.col("extra") + F.when(F.col("_left") >= 0, F.col("_moved")).otherwise(-F.col("_moved"))).alias("extra"),
    )


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The documents in the mix, each as often as it is taken; columns unchanged.

    Rows of one id share a number of copies: the greatest that any of them was given. Null and empty texts follow their source's
    rate, very long ones count whole, other columns may have any name, and an empty table gives an empty result.
    """
    chosen = mix(docs, weights, most).groupBy(F.col("doc_id").alias("_id")).agg(F.max("copies").alias("_copies"))
    # The document as one column, so that none of its columns can clash.
    held = docs.select(F.col("doc_id").alias("_key"), F.struct("*").alias("document"))
    many = held.join(chosen.filter("_copies > 0").hint("merge"), F.col("_key").eqNullSafe(F.col("_id")))
    return many.select("document", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")).select("document.*")
