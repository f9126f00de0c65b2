"""Sharding: balanced label propagation (DataFrame code only).

Documents are linked when their texts are equal.  Every document starts in a
shard given by its hash.  In each round a linked group looks at the shards of
its members and moves to the one where most of them are, as long as that shard's
quota allows; groups that found no room look again among all shards that still
have enough, until no group moves.  A group larger than half a shard is dealt into parts first, so no
group needs a whole shard, and none is one task.  Documents without links, and
groups that no shard has room for any more, fill the shards up to equal load in hash order.

Law ``rows``: shard counts differ by one at most.  Law ``bytes``: loads in bytes
differ by the largest document at most.

Defined results: a null text has no bytes, no links and checksum 0; rows
repeated with the same id are separate rows; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sectionmap.llm.common import join_hot, running_total, shuffle_width, stage

OVERHEAD = 8  # bytes counted for each document besides its text


def measured(docs: DataFrame) -> DataFrame:
    """(row, doc_id, size, text_crc32, link): ``row`` tells rows of one id apart."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                       (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.unhex(F.md5("text")).alias("link"))


def propagate(units: DataFrame, quota: list[float]) -> DataFrame:
    """(link, part, shard) of the groups that found room.

    ``units``: (link, part, label, n, load), one row per group and current
    label, so at most as many rows a group as there are shards.  Of the groups that
    want a shard with room the first in line always fits, so every round but the last places some.
    """
    spark = units.sparkSession
    free = [float(q) for q in quota]
    votes, placed = units, []
    total = stage(spark, units.groupBy("link", "part").agg(F.sum("load").alias("all")), "units")
    while True:
        rooms = F.array(*[F.lit(f) for f in free])
        fits = F.max(F.when(F.element_at(rooms, F.col("label") + 1) >= F.col("all"),
                            F.struct("n", F.xxhash64("link", "part", "label").alias("_h"), "label")))
        # Without a label that has room: any shard that has, by the group's hash.
        others = F.filter(F.sequence(F.lit(0), F.lit(len(free) - 1)), lambda s: F.element_at(rooms, s + 1) >= F.col("all"))
        wish = (votes.join(total, ["link", "part"]).groupBy("link", "part", "all").agg(fits.alias("best")).withColumn("_others", others)
                .withColumn("shard", F.coalesce("best.label", F.when(F.size("_others") > 0, F.get(
                    "_others", F.pmod(F.xxhash64("link", "part"), F.size("_others")).cast("int")))))
                .where("shard IS NOT NULL").select("link", "part", "all", "shard"))
        line = running_total(wish, ["shard"], F.xxhash64("part", "link"), [F.xxhash64("link"), F.col("link"), F.col("part")],
                             F.col("all"), "before", shuffle_width(spark))
        room = F.element_at(rooms, F.col("shard") + 1)
        moved = stage(spark, line.where(F.col("before") + F.col("all") <= room).select("link", "part", "shard", "all"), "moved")
        loads = moved.groupBy("shard").agg(F.sum("all"), F.count("*")).collect()  # one row per shard at most
        placed.append(moved.select("link", "part", "shard"))
        for shard, load, _n in loads:
            free[shard] -= float(load)
        if not loads:
            break
        left = stage(spark, total.join(moved, ["link", "part"], "left_anti"), "left")
        if left.isEmpty():
            break
        votes, total = votes.join(left.select("link", "part"), ["link", "part"], "left_semi"), left
    out = placed[0]
    for p in placed[1:]:
        out = out.unionByName(p)
    return stage(spark, out, "placed")


def shard_documents(docs: DataFrame, shards: int = 24, law: str = "rows") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    base = stage(spark, measured(docs), "measured")
    weight: Column = F.lit(1) if law == "rows" else F.col("size")
    count, load = base.agg(F.count("*"), F.coalesce(F.sum(weight), F.lit(0))).first()
    if law == "rows":
        quota = [count // shards + (s < count % shards) for s in range(shards)]
    else:
        quota = [load / shards] * shards
    half = max(1.0, load / shards / 2)
    groups = stage(spark, base.where(F.col("link").isNotNull()).groupBy("link").agg(F.count("*").alias("_n"), F.sum(weight).alias("_load"))
                   .where(F.col("_n") > 1).select("link", "_n", F.ceil(F.col("_load") / half).cast("int").alias("parts")), "groups")
    linked = stage(spark, join_hot(base, groups, "link", F.col("_n"))
                   .select("row", "link", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int").alias("part"),
                           F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(shards)).cast("int").alias("label"), weight.alias("load")), "linked")
    units = stage(spark, linked.groupBy("link", "part", "label").agg(F.count("*").alias("n"), F.sum("load").alias("load")), "votes")
    placed = propagate(units, quota)
    homes = stage(spark, linked.join(placed, ["link", "part"]).select("row", "shard", "load"), "homes")
    used = dict(homes.groupBy("shard").agg(F.sum("load")).collect())  # one row per shard
    # What is left fills the shards' remaining room in hash order.
    rest = running_total(base.join(homes.select("row"), "row", "left_anti"), [], F.xxhash64("doc_id"),
                         [F.xxhash64("doc_id"), F.col("row")], weight, "before", 4 * shuffle_width(spark))
    at = F.col("before") + (F.lit(0) if law == "rows" else F.col("size") / 2)
    edge, edges = 0.0, []
    for s in range(shards - 1):
        edge += quota[s] - float(used.get(s, 0))
        edges.append(edge)
    filled = rest.withColumn("shard", sum((F.when(at >= e, 1).otherwise(0) for e in edges), F.lit(0)).cast("int"))
    cols = ["row", "doc_id", "size", "text_crc32", "shard"]
    both = base.join(homes.select("row", "shard"), "row").select(*cols).unionByName(filled.select(*cols))
    both = stage(spark, both, "shards")
    slotted = running_total(both, ["shard"], F.xxhash64("doc_id"), [F.xxhash64("doc_id"), F.col("row")], F.lit(1), "slot",
                            4 * shuffle_width(spark))
    return slotted.select("doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard",
                          F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
