"""Connected components as iterated contractions, cut by written tables."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sectionmap.llm.common import join_hot, shuffle_width, stage

#: Links that are contracted together inside a task.
LINKS = 1 << 20


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each member's component under the pairs (a, b)."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        # A root that has a smaller neighbour takes its whole tree along.
        np.minimum.at(low, root, low)
        while True:
            jumped = low[low]
            if (jumped == low).all():
                break
            low = jumped
        if (low == root).all():
            return root
        root = low


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) of a partition as links of every node to the smallest one it reaches there."""
    held: list[pa.RecordBatch] = []

    def star() -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        both = pa.concat_arrays([t.column(c).combine_chunks() if isinstance(t.column(c), pa.ChunkedArray) else t.column(c) for c in ("u", "v")]).dictionary_encode()
        order = pc.array_sort_indices(both.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        codes = rank[both.indices.to_numpy()]
        root = roots(len(order), *codes.reshape(2, -1))
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([both.dictionary.take(pa.array(order[x])) for x in (moved, root[moved])], ["u", "v"])

    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= LINKS:
            yield star()
            held = []
    if sum(map(len, held)):
        yield star()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): label is the smallest node of the component.

    Every task first contracts the links it has, so that a node has one parent, the
    smallest node it reaches there, at most once a partition.  Then, until every parent is a root, links
    meet by their child and are contracted again, and every parent is replaced by its own
    parent; a parent that holds a large share of all links is joined by a broadcast of
    bounded size.  A step only ever replaces a parent by a smaller one, so it ends.
    """
    spark = edges.sparkSession
    ddl = ", ".join(f"{k} {edges.schema[a].dataType.simpleString()}" for k in "uv")
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v")
    links = stage(spark, pairs.mapInArrow(_contract, ddl), "links")

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    seen = state(links)
    while seen[0]:
        met = stage(spark, links.repartition(shuffle_width(spark), "u").mapInArrow(_contract, ddl), "met")
        # A node may be moved in several partitions: any of its parents leads on, the rest are links too.
        parent = met.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("w"))
        children = met.groupBy("v").agg(F.count("*").alias("n"))
        table = stage(spark, children.join(parent, "v", "left").select("v", F.coalesce("w", "v").alias("w"), "n"), "parents")
        if state(met) == seen and table.where("w != v").isEmpty():
            break
        jumped = join_hot(met, table, "v", F.col("n")).select("u", F.col("w").alias("v"))
        links = stage(spark, jumped.dropDuplicates(), "links")
        seen = state(links)
    return links.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("label")).dropDuplicates())
