"""Loops that run to their end, extreme ids, many sizes, large groups, states of the machine."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from sectionmap.llm import chat, language, mixing, sharding, suffix_dedup
from sectionmap.llm.components import components


def union_find(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("shape", ["path", "star", "random", "loops"])
def test_components_end_with_the_components(spark, shape):
    rnd = random.Random(4)
    names = rnd.sample(range(10**6), 2001)
    pairs = {"path": list(zip(names, names[1:])), "star": [(max(names), x) for x in names if x != max(names)],
             "random": [tuple(rnd.sample(names, 2)) for _ in range(1800)], "loops": [(5, 5), (7, 7)]}[shape]
    rnd.shuffle(pairs)
    # As many partitions as there are links a few: nothing is contracted by chance.
    df = spark.createDataFrame([(f"n{a:07d}", f"n{b:07d}") for a, b in pairs], "a string, b string").repartition(40)
    got = {r["node"]: r["label"] for r in components(df).collect()}
    assert got == {f"n{a:07d}": f"n{b:07d}" for a, b in union_find(p for p in pairs if p[0] != p[1]).items()}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a binary, b binary")).count() == 0


def test_sharding_places_every_group_that_fits(spark):
    # 12 groups of 5 in 6 shards of 20: each shard has room for 4 of them, whatever their votes.
    rows = [(i, f"group {i // 5} text") for i in range(60)] + [(100 + i, f"single {i}") for i in range(60)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), shards=6).collect()
    count = collections.Counter(r["shard"] for r in got)
    assert set(count.values()) == {20}
    home = collections.defaultdict(set)
    for r in got:
        if r["doc_id"] < 60:
            home[r["doc_id"] // 5].add(r["shard"])
    assert all(len(s) == 1 for s in home.values())


def test_sharding_of_groups_that_do_not_fit(spark):
    # One group larger than a shard, one of two thirds of one, and null texts.
    rows = [(i, "big") for i in range(50)] + [(50 + i, "other") for i in range(20)] + [(70 + i, None) for i in range(20)] + [(7, "big"), (None, "big")]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), shards=3).collect()
    count = collections.Counter(r["shard"] for r in got)
    assert len(got) == 92 and max(count.values()) - min(count.values()) <= 1
    for s in count:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(count[s]))


def test_mixing_many_sizes_and_repeated_rows(spark):
    docs = spark.range(6000).select((F.col("id") % 2999).alias("doc_id"), F.lit("s").alias("source"), F.repeat(F.lit("w "), (F.col("id") + 1).cast("int")).alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(None, None, "a b c")] * 40, "doc_id long, source string, text string"))
    got = mixing.mix(docs).collect()
    per = collections.defaultdict(lambda: [0, 0.0])
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        per[r["source"]][0] += r["taken"]
        per[r["source"]][1] = r["target"]
    assert len(got) == 6040 and all(abs(a - b) <= max(3, 0.001 * b) for a, b in per.values())
    again = mixing.mix(docs.repartition(7)).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(map(tuple, again))


def test_mixing_that_misses_its_target_is_an_error(spark):
    sizes = spark.createDataFrame([("a", 10, 5), ("a", 11, 3)], "source string, size long, n long")
    targets = mixing.source_targets(sizes, budget=0.7)
    with pytest.raises(ArithmeticError):
        mixing.solve_rates(sizes, targets, tolerance=0.0, max_steps=2)


def test_machine_states(spark):
    turns = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (2, 0, "user", "u"), (2, 1, "user", "again"), (2, 2, "assistant", "a"),
             (None, 0, "user", "n"), (None, 1, "assistant", "m"), (3, 0, "user", "only"), (4, 1, "user", "b"), (4, 1, "assistant", "a"), (5, None, "tool", "x"),
             (6, 0, "user", "x " * 100_000), (6, 1, "assistant", None)]
    out = {r["conv_id"]: r for r in chat.format_chats(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()}
    at = lambda c: [s["state"] for s in out[c]["segments"]][1::3]
    assert at(1) == ["system", "user", "assistant"] and (out[1]["valid"], out[1]["n_rejected"]) == (True, 0)
    assert at(2) == ["user", "reject", "reject"] and (out[2]["valid"], out[2]["n_rejected"]) == (False, 2)
    assert out[None]["valid"] and (out[3]["valid"], out[3]["n_rejected"]) == (False, 0)
    # Equal turn numbers are ordered by role: the assistant comes first and is rejected.
    assert (out[4]["valid"], out[4]["n_rejected"]) == (False, 2) and out[5]["n_rejected"] == 1
    assert out[6]["valid"] and out[6]["segments"][4]["text"] == "" and len(out[6]["segments"][1]["text"]) == 200_000


def test_extreme_and_null_ids(spark):
    last, passage = (1 << 63) - 1, "a passage that is long enough to be found twice in other texts, indeed"
    docs = spark.createDataFrame([(last, passage), (None, "unlike it"), (-(1 << 63), passage + "!")], "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.dedup_substrings(docs).collect()}
    assert got == {last: len(passage), None: 0, -(1 << 63): 0}
    held = {r["doc_id"]: r["h"] for r in docs.select("doc_id", language.held_out(F.col("doc_id")).alias("h")).collect()}
    assert held[None] is False and None not in held.values()
