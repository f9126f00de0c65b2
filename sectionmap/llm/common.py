"""Helpers shared by the training-data operators (DataFrame code only)."""

from __future__ import annotations

import string
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sectionmap.session import scratch_dir

#: The blank characters of every contract: space and \t \n \v \f \r.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: the lineage ends there, columns are pruned by later readers, and a
    lost executor costs nothing but its own tasks."""
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` evaluated once per row (a lambda variable)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(
        F.translate(c, string.ascii_uppercase, string.ascii_lowercase))


def count_chars(c: Column, char_class: str) -> Column:
    """Code points of ``c`` inside a regex character class."""
    return (F.length(c) - F.length(F.regexp_replace(c, char_class, ""))).cast("long")


def join_hot(rows: DataFrame, table_: DataFrame, key: str, count: Column, how: str = "inner", share: int = 1000) -> DataFrame:
    """``rows`` joined with ``table_`` (one row a key; ``count``: its rows in ``rows``).

    Keys that hold one row in ``share`` or more are at most ``share`` keys, so
    their rows of ``table_`` are broadcast and no task gathers such a key; the
    other keys are joined by a shuffle."""
    total = table_.agg(F.sum(count)).first()[0] or 0
    is_hot = count * share >= total
    hot = F.broadcast(table_.where(is_hot))
    rest = rows.join(hot.select(key), key, "left_anti").join(table_.where(~is_hot), key, how)
    return rows.join(hot, key).unionByName(rest)


def running_total(df: DataFrame, keys: Sequence[str], spread: Column, order: Sequence[Column],
                  value: Column, out: str, buckets: int) -> DataFrame:
    """Exclusive running total of ``value`` within ``keys`` without a task per key.

    Rows are dealt into ``buckets`` slices by the hash ``spread``; the total
    order is (slice, ``order``).  Slice sums are added up first (one row per key
    and slice), so the row window runs per (key, slice): a key that holds a
    third of all rows is split over every slice.
    """
    sliced = df.withColumn("_slice", F.pmod(spread, F.lit(buckets)).cast("int")).withColumn("_value", value)
    sums = sliced.groupBy(*keys, "_slice").agg(F.sum("_value").alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_slice").alias("_s"),
                         F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col("_slice") == F.col("_s")]
    within = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = sliced.withColumn("_within", F.coalesce(F.sum("_value").over(within), F.lit(0)))
    return (placed.join(starts, on, "left").withColumn(out, F.col("_start") + F.col("_within"))
            .drop("_slice", "_value", "_within", "_s", "_start", *[f"_k{i}" for i in range(len(keys))]))
