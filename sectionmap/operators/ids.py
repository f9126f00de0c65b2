"""Contiguous surrogate ids in a total order, computed without funnelling all
rows through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sectionmap.operators.ordered import whole_row
from sectionmap.session import staged


def sequential_ids(df: DataFrame, order_by: list, start: Column, name: str = "id") -> DataFrame:
    """Add ``name`` = start + 1, start + 2, ... following ``order_by``.

    Ties are broken by the whole row, so equal keys get the same ids on every run and
    however the rows are partitioned; only rows equal in all columns may swap.

    The rows are range-partitioned by the sort; each partition counts its rows,
    the per-partition counts (one row per partition) give offsets, and each row adds its position inside
    its partition.  The numbered rows are written once as Parquet in the shared
    folder, so the numbers stay fixed and later readers prune columns.
    """
    df, order_by = df.withColumn("_tie", whole_row(df)), [*order_by, "_tie"]
    ordered = df.orderBy(*order_by).withColumn("_part", F.spark_partition_id())
    ordered = staged(ordered.withColumn(
        "_pos", F.row_number().over(Window.partitionBy("_part").orderBy(*order_by))), "numbered")
    counts = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_part", F.coalesce(
        F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_off"))
    out = ordered.join(offsets, "_part")
    return out.withColumn(name, (start + F.col("_off") + F.col("_pos")).cast("int")).drop("_part", "_pos", "_off", "_tie")
