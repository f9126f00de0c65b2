"""Interval (page-range) joins: find the record whose [start, start + len)
covers a point, within equal keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sectionmap.operators.ordered import running

#: Longest interval that may be taken apart, in points or blocks.
LONGEST = 100_000


def _checked(length):
    """The length, an error when no page range can be that long (the plan would take it apart)."""
    return F.when(length > LONGEST, F.raise_error(F.concat(F.lit("interval too long: "), length.cast("string"))).cast("int")).otherwise(length)


def _covered_range(start, length):
    return F.when(length >= 1, F.sequence(start, start + _checked(length) - 1)).otherwise(F.array().cast("array<int>"))


def interval_join(points: DataFrame, intervals: DataFrame, keys: list[str], point: str,
                  start: str, length: str, how: str = "left", bucket: int = 16) -> DataFrame:
    """Bucketed range join.

    Each interval is copied into the ``bucket``-wide blocks it touches
    (ceil(len / bucket) + 1 copies at most), each point falls in one block, and
    the join is an equi join on keys + block with the range test as a residual.
    A hot key (one book holding many maps) is spread over its blocks instead of
    becoming one large cartesian task, and long intervals do not blow up the
    way a per-page explode would.
    """
    b = F.lit(bucket)
    iv = intervals.withColumn("_blk", F.explode(F.when(
        F.col(length) >= 1, F.sequence(F.floor(F.col(start) / b), F.floor((F.col(start) + _checked(F.col(length)) - 1) / b)))
        .otherwise(F.array().cast("array<bigint>"))))
    pt = points.withColumn("_blk", F.floor(F.col(point) / b))
    cond = [pt[k] == iv[k] for k in keys] + [pt["_blk"] == iv["_blk"],
                                             iv[start] <= pt[point], (iv[start] + iv[length]) > pt[point]]
    joined = pt.join(iv, cond, how)
    return joined.drop(iv["_blk"]).drop(pt["_blk"]).drop(*[iv[k] for k in keys])


def interval_join_exploded(points: DataFrame, intervals: DataFrame, keys: list[str], point: str,
                           start: str, length: str, how: str = "left") -> DataFrame:
    """Per-unit variant: every interval becomes one row per covered point and
    the join is a pure equi join (best when intervals are short)."""
    iv = intervals.withColumn("_p", F.explode(_covered_range(F.col(start), F.col(length))))
    cond = [points[k] == iv[k] for k in keys] + [points[point] == iv["_p"]]
    return points.join(iv, cond, how).drop(iv["_p"]).drop(*[iv[k] for k in keys])


def overlaps(intervals: DataFrame, keys: list[str], start: str, length: str, order: list[str]) -> DataFrame:
    """C10's audit: intervals that begin inside an earlier one of their keys, with
    ``covered_to``, the largest end so far.  A sweep over the starts; the largest end is
    carried across the partitions of a hot key.  Empty intervals neither cover nor count."""
    iv = intervals.where(F.col(length) >= 1)
    end = F.col(start) + F.col(length) - 1
    swept = running(iv, keys, [start, *order], {"covered_to": ("max", end)})
    return swept.where(F.col(start) <= F.col("covered_to"))
