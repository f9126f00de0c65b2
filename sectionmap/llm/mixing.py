"""Mixing sources to target weights: entropy balancing (DataFrame code only).

Each source gets a token target: a share of ``budget`` times all tokens by its
weight, at most ``cap`` times its own tokens, the excess reshared by weight.
Among all document rates in [0, cap] that meet a source's target, the ones
closest to one copy each in relative entropy are exponential tilts,
``rate = min(cap, exp(lambda * size / mean size))``.  The multipliers solve the
convex dual; Newton steps, held inside a bracket, run for all sources at once as
Spark aggregations.  The rate depends on source and size only, so the steps run
over the histogram (source, size, documents), which also splits no hot source
over tasks unevenly.

Rates become whole copies by carrying the token error from the largest size to
the smallest; inside one (source, size) class the documents with the smallest
hashes of id and text get the extra copy, ranked over hash slices.

Defined results: a null or blank text has size 0 and takes nothing; a null
source is one source, last in order; repeated rows are separate rows of the
mix; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sectionmap.llm.common import WORD, running_total, shuffle_width, stage

WEIGHTS = (3.0, 1.0, 2.0)
BLOCK = 256  # classes that are rounded in one array


def sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", F.xxhash64("doc_id", "text").alias("spread"),
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def source_targets(histogram: DataFrame, weights=WEIGHTS, budget: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, docs, smallest, target): one row per source."""
    per = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"),
                                          F.sum(F.when(F.col("size") > 0, F.col("n")).otherwise(0)).alias("docs"),
                                          F.min(F.when(F.col("size") > 0, F.col("size"))).alias("smallest"))
    # One row per source; the window's single task holds sources, not documents.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("limit", cap * F.col("source_size"))
    # Sources fill up in the order limit/weight: one is full if the level that
    # the rest would share reaches its limit.
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    full = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy())
    per = per.withColumn("level", (budget * total - full) / rest).withColumn("is_full", F.col("limit") <= F.col("level") * F.col("weight"))
    level = F.max(F.when(~F.col("is_full"), F.col("level"))).over(Window.partitionBy())
    target = F.when(F.col("is_full") | level.isNull(), F.col("limit")).otherwise(level * F.col("weight"))
    return per.select("source", "source_size", "docs", "smallest", target.alias("target"))


def _rate(lam: Column, size: Column, mean: Column, cap: float) -> Column:
    tilt = lam * size / mean
    return F.when(tilt >= math.log(cap), F.lit(cap)).otherwise(F.exp(tilt))


def solve_rates(histogram: DataFrame, targets: DataFrame, cap: float = 2.0, tolerance: float = 1e-9,
                max_steps: int = 200) -> DataFrame:
    """(source, lam, mean, saturated) with the tilt of each source; an error if a source
    misses its target after ``max_steps`` (each step at least halves its bracket)."""
    spark = histogram.sparkSession
    ratio = F.col("target") / F.col("source_size")
    mean = F.col("source_size") / F.col("docs")
    base = targets.where(F.col("source_size") > 0).select(
        "source", "target", mean.alias("mean"), (ratio >= cap * (1 - 1e-12)).alias("saturated"),
        # exp(lam * x) is below target/size for every x at lo, and every rate is at the cap at hi.
        F.when(ratio < 1, F.log(ratio) * mean / F.col("smallest")).otherwise(F.lit(0.0)).alias("lo"),
        F.when(ratio > 1, math.log(cap) * mean / F.col("smallest")).otherwise(F.lit(0.0)).alias("hi"),
        F.log(F.least(ratio, F.lit(cap))).alias("lam"))
    state = stage(spark, base.withColumn("off", F.lit(None).cast("double")), "dual")
    for _ in range(max_steps):
        s = state.select(F.col("source").alias("_source"), "target", "mean", "saturated", "lo", "hi", "lam")
        x = F.col("size") / F.col("mean")
        rate = _rate(F.col("lam"), F.col("size"), F.col("mean"), cap)
        mass = F.col("n") * F.col("size")
        sums = (histogram.where(F.col("size") > 0).join(s, F.col("source").eqNullSafe(F.col("_source")))
                .groupBy("_source").agg(
                    F.sum(mass * rate).alias("got"),
                    F.sum(F.when(rate < cap, mass * rate * x).otherwise(0.0)).alias("slope"),
                    *[F.first(c).alias(c) for c in ("target", "mean", "saturated", "lo", "hi", "lam")]))
        # Newton on log(got) = log(target); a step outside the bracket halves it.
        off = F.log(F.col("got") / F.col("target"))
        lo = F.when(F.col("got") < F.col("target"), F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(F.col("got") > F.col("target"), F.col("lam")).otherwise(F.col("hi"))
        step = F.col("lam") - off * F.col("got") / F.col("slope")
        inside = (F.col("slope") > 0) & (step > lo) & (step < hi)
        settled = F.col("saturated") | (F.abs(off) <= tolerance)
        state = stage(spark, sums.select(
            F.col("_source").alias("source"), "target", "mean", "saturated", lo.alias("lo"), hi.alias("hi"),
            F.when(settled, F.col("lam")).when(inside, step).otherwise((lo + hi) / 2).alias("lam"),
            F.when(settled, F.lit(0.0)).otherwise(F.abs(off)).alias("off")), "dual")
        if not (state.agg(F.max("off")).first()[0] or 0.0) > tolerance:
            break
    else:
        raise ArithmeticError(f"the rates miss their targets after {max_steps} steps")
    return state.select("source", "lam", "mean", "saturated")


def class_copies(histogram: DataFrame, targets: DataFrame, rates: DataFrame, cap: float = 2.0) -> DataFrame:
    """(source, size, n, copies): whole copies of each class of equal size.

    A source's classes are its distinct sizes, at most the words of the longest
    text; the carried error ends below half the smallest size.
    """
    r = rates.select(F.col("source").alias("_source"), "lam", "mean", "saturated")
    rate = F.when(F.col("saturated"), F.lit(cap)).otherwise(_rate(F.col("lam"), F.col("size"), F.col("mean"), cap))
    classes = (histogram.where(F.col("size") > 0).join(r, F.col("source").eqNullSafe(F.col("_source")))
               .groupBy("source").agg(F.reverse(F.array_sort(F.collect_list(F.struct("size", "n", rate.alias("rate"))))).alias("c")))
    kind = "array<struct<size:bigint,n:bigint,copies:bigint>>"
    # In blocks: an array is copied when it grows, so one array of all classes would cost their square.
    blocks = F.transform(F.sequence(F.lit(0), (F.size("c") - 1).cast("int"), F.lit(BLOCK)), lambda at: F.slice("c", at + 1, F.lit(BLOCK)))

    def step(acc: Column, c: Column) -> Column:
        want = c["n"] * c["rate"] + acc["carry"] / c["size"]
        copies = F.least(F.greatest(F.floor(want + 0.5), F.lit(0)), (c["n"] * cap).cast("long")).cast("long")
        return F.struct(((want - copies) * c["size"]).alias("carry"),
                        F.concat(acc["out"], F.array(F.struct(c["size"].alias("size"), c["n"].alias("n"), copies.alias("copies")))).alias("out"))

    def block(acc: Column, b: Column) -> Column:
        done = F.aggregate(b, F.struct(acc["carry"].alias("carry"), F.expr(f"cast(array() as {kind})").alias("out")), step)
        return F.struct(done["carry"].alias("carry"), F.concat(acc["out"], F.array(done["out"])).alias("out"))

    empty = F.expr(f"named_struct('carry', 0D, 'out', cast(array() as array<{kind}>))")
    return (classes.select("source", F.explode(F.aggregate(blocks, empty, block, lambda a: F.flatten(a["out"]))).alias("k"))
            .select("source", "k.size", "k.n", "k.copies"))


def mix(docs: DataFrame, weights=WEIGHTS, budget: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate, copies, taken."""
    spark = docs.sparkSession
    sizes = stage(spark, sized(docs), "sizes")
    histogram = stage(spark, sizes.groupBy("source", "size").agg(F.count("*").alias("n")), "histogram")
    targets = stage(spark, source_targets(histogram, weights, budget, cap), "targets")
    rates = solve_rates(histogram, targets, cap)
    classes = stage(spark, class_copies(histogram, targets, rates, cap), "classes")
    ranked = running_total(sizes, ["source", "size"], F.col("spread"), [F.col("spread"), F.col("doc_id")],
                           F.lit(1), "rank", 4 * shuffle_width(spark))
    c = classes.select(F.col("source").alias("_source"), F.col("size").alias("_size"), "n", "copies")
    t = targets.select(F.col("source").alias("_src"), "source_size", "target")
    extra = F.when(F.col("rank") < F.col("copies") % F.col("n"), 1).otherwise(0)
    out = (ranked.join(c, F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size")), "left")
           .join(t, F.col("source").eqNullSafe(F.col("_src")), "left")
           .withColumn("copies", F.when(F.col("size") == 0, F.lit(0)).otherwise(F.expr("copies div n") + extra).cast("long")))
    return out.select("doc_id", "source", "size", "source_size", "target",
                      (F.col("copies") * F.col("size")).alias("taken"), "copies")
