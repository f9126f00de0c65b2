"""Running totals, counts and maxima within keys, without a task per key.

The rows are range-partitioned on (keys, order), so one key may lie in many
partitions; each partition runs its own windows, and what the partitions before
it add up to (one row a partition and key) is carried in.  ``order`` is total: every
other column is a last key, so equal rows are the only ones that may swap.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sectionmap.session import staged

COMBINE = {"sum": F.sum, "max": F.max}


def whole_row(df: DataFrame) -> Column:
    """The whole row as text, the last key of a total order: rows that differ never tie."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))


def running(df: DataFrame, keys: Sequence[str], order: Sequence, aggs: dict[str, tuple[str, Column]]) -> DataFrame:
    """``df`` with, for each out -> (sum or max, value), that aggregate over the rows
    before this one within ``keys`` (NULL on the first).  Written once."""
    rows = df.withColumns({f"_v_{o}": v for o, (_, v) in aggs.items()}).withColumn("_order", whole_row(df))
    ordered = staged(rows.orderBy(*keys, *order, "_order").withColumn("_part", F.spark_partition_id()), "ordered")
    within = Window.partitionBy("_part", *keys).orderBy(*order, "_order").rowsBetween(Window.unboundedPreceding, -1)
    here = ordered.withColumns({f"_w_{o}": COMBINE[how](f"_v_{o}").over(within) for o, (how, _) in aggs.items()})
    parts = ordered.groupBy("_part", *keys).agg(*[COMBINE[how](f"_v_{o}").alias(f"_s_{o}") for o, (how, _) in aggs.items()])
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = parts.select(F.col("_part").alias("_cp"), *[F.col(k).alias(f"_ck_{k}") for k in keys],
                         *[COMBINE[how](f"_s_{o}").over(before).alias(f"_c_{o}") for o, (how, _) in aggs.items()])
    on = [here["_part"] == carry["_cp"]] + [here[k].eqNullSafe(carry[f"_ck_{k}"]) for k in keys]
    out = here.join(carry, on, "left")
    for o, (how, _) in aggs.items():
        a, b = F.col(f"_w_{o}"), F.col(f"_c_{o}")
        both = F.greatest(a, b) if how == "max" else F.when(a.isNull() & b.isNull(), None).otherwise(F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
        out = out.withColumn(o, both)
    return out.select(*df.columns, *aggs)
