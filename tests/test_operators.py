"""Operators against brute force on small inputs."""

import random

from pyspark.sql import functions as F

from sectionmap.operators.ids import sequential_ids
from sectionmap.operators.intervals import interval_join, interval_join_exploded


def brute_lookup(points, intervals):
    out = {}
    for pid, k, p in points:
        hits = [iid for iid, ik, s, n in intervals if ik == k and s <= p < s + n]
        out[pid] = min(hits) if hits else None
    return out


def test_interval_join_matches_brute_force(spark):
    rnd = random.Random(7)
    intervals = [(i, rnd.choice(["A", "B", "HOT", "HOT", "HOT"]), rnd.randint(-5, 200), rnd.choice([0, -1, 1, 2, 3, 17, 40]))
                 for i in range(300)]
    points = [(j, rnd.choice(["A", "B", "HOT", "C"]), rnd.randint(-10, 260)) for j in range(500)]
    iv = spark.createDataFrame(intervals, "iid int, k string, start int, len int")
    pt = spark.createDataFrame(points, "pid int, k string, p int")
    expected = brute_lookup(points, intervals)
    for fn in (interval_join, interval_join_exploded):
        kw = {"bucket": 8} if fn is interval_join else {}
        j = fn(pt, iv, ["k"], "p", "start", "len", **kw)
        got = {r["pid"]: r["iid"] for r in j.groupBy("pid").agg(F.min("iid").alias("iid")).collect()}
        assert got == expected, fn.__name__


def test_sequential_ids(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("k"))
    out = sequential_ids(df.repartition(5), ["k"], F.lit(100)).collect()
    got = sorted((r["k"], r["id"]) for r in out)
    assert got == [(k, 101 + k) for k in range(5000)]
