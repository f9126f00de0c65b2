"""Quality rules with weak supervision (DataFrame code only).

Each rule votes good (+1) or bad (-1) or abstains (0).  Expectation-maximisation
over the vote patterns estimates how often each rule is right and the share of
good documents; a document's posterior probability of being good replaces
"all rules must pass".  There are at most 3^rules patterns (a few thousand)
whatever the input, so they are the only thing that reaches the driver.

Defined results: a null or blank text has no words, fails the base rule and is
not kept; rows repeated are judged alike; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sectionmap.llm.common import WORD, count_chars, let, stage

WINDOW = 5


def repeated_words(words: Column) -> Column:
    """Words inside five-word windows that occur twice or more in the text."""
    def covered(starts: Column) -> Column:
        return F.aggregate(
            F.transform(starts, lambda v, k: F.when(k + 1 < F.size(starts), F.least(F.lit(WINDOW), F.get(starts, k + 1) - v)).otherwise(WINDOW)),
            F.lit(0).cast("long"), lambda a, v: a + v)

    def equal_neighbour(s: Column) -> Column:
        def keep(e: Column, k: Column) -> Column:
            left = (k > 0) & (F.get(s, k - 1)["h"] == e["h"])
            right = (k + 1 < F.size(s)) & (F.get(s, k + 1)["h"] == e["h"])
            return F.when(left | right, e["i"])
        return F.array_sort(F.array_compact(F.transform(s, keep)))

    def of_windows(win: Column) -> Column:
        pairs = F.array_sort(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("i"))))
        return F.when(F.size(F.array_distinct(win)) == F.size(win), F.lit(0).cast("long")).otherwise(
            let(pairs, lambda s: let(equal_neighbour(s), covered)))

    def of_hashes(h: Column) -> Column:
        n = F.size(h) - WINDOW + 1
        win = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(WINDOW)]))
        return F.when(n < 2, F.lit(0).cast("long")).otherwise(let(win, of_windows))

    return let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def features(docs: DataFrame) -> DataFrame:
    """Counts over whole texts, one row per document."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda l: F.rlike(l, F.lit(WORD)))
    words = let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
        F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
        repeated_words(w).alias("n_repeat_words")))
    dup = let(lines, lambda l: F.struct(F.size(l).cast("long").alias("n_lines"),
                                        (F.size(l) - F.size(F.array_distinct(l))).cast("long").alias("n_dup_lines")))
    return (docs.select("doc_id", words.alias("w"), dup.alias("l"),
                        count_chars(text, r"[#*$%&|<>]").alias("n_symbols"),
                        count_chars(text, r"[A-Z]").alias("n_upper"))
            .select("doc_id", "w.*", "l.*", "n_symbols", "n_upper"))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(F.coalesce(bad, F.lit(False)), -1).when(F.coalesce(good, F.lit(False)), 1).otherwise(0).cast("int")


def votes() -> dict[str, Column]:
    """The rules; shares of an empty text are null, so it abstains there."""
    n, chars, lines = F.col("n_words"), F.col("word_chars"), F.col("n_lines")

    def share(a: Column, b: Column) -> Column:
        return a / F.when(b > 0, b)

    return {
        "length": _vote(n >= 50, n < 10),
        "symbols": _vote(F.col("n_symbols") == 0, share(F.col("n_symbols"), chars) > 0.05),
        "marks": _vote(share(F.col("n_symbols"), n) < 0.02, share(F.col("n_symbols"), n) > 0.3),
        "word_size": _vote(share(chars, n).between(3, 10), (share(chars, n) < 2) | (share(chars, n) > 15)),
        "repeats": _vote(share(F.col("n_repeat_words"), n) < 0.02, share(F.col("n_repeat_words"), n) > 0.2),
        "lines": _vote((lines > 1) & (F.col("n_dup_lines") == 0), share(F.col("n_dup_lines"), lines) > 0.3),
        "capitals": _vote(share(F.col("n_upper"), chars) < 0.1, share(F.col("n_upper"), chars) > 0.4),
        "variety": _vote((n >= 50) & (share(F.col("n_distinct"), n) > 0.3), (n >= 50) & (share(F.col("n_distinct"), n) < 0.1)),
    }


def fit(patterns: list[tuple[tuple[int, ...], int]], steps: int = 50) -> tuple[float, list[tuple[float, float]]]:
    """(share of good, per rule its accuracy on good and on bad documents) by
    expectation-maximisation over (votes, documents).  Accuracies stay within
    [0.6, 0.995] on good documents and [0.05, 0.995] on bad ones, where most rules
    miss most faults; a bad vote is always evidence of a bad document."""
    m = len(patterns[0][0]) if patterns else 0
    prior, acc = 0.8, [(0.95, 0.4)] * m
    for _ in range(steps):
        share, total = 0.0, 0.0
        right, cast = [[0.0, 0.0] for _ in range(m)], [[0.0, 0.0] for _ in range(m)]
        for v, n in patterns:
            p = posterior(prior, acc, v)
            share, total = share + n * p, total + n
            for j, x in enumerate(v):
                if x:
                    cast[j][0] += n * p
                    cast[j][1] += n * (1 - p)
                    right[j][0] += n * p * (x > 0)
                    right[j][1] += n * (1 - p) * (x < 0)
        prior = min(max(share / max(total, 1e-9), 0.05), 0.95)
        acc = [(min(max((r[0] + 0.95) / (c[0] + 1), 0.6), 0.995), min(max((r[1] + 0.4) / (c[1] + 1), 0.05), 0.995))
               for r, c in zip(right, cast)]
    return prior, acc


def weights(acc: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Log odds that a good vote and a bad vote of each rule add."""
    return [(math.log(g / (1 - b)), min(math.log((1 - g) / b), 0.0)) for g, b in acc]


def posterior(prior: float, acc: list[tuple[float, float]], v: tuple[int, ...]) -> float:
    odds = math.log(prior / (1 - prior)) + sum(w[0] if x > 0 else w[1] for w, x in zip(weights(acc), v) if x)
    return 1 / (1 + math.exp(-odds))


def judge(docs: DataFrame, threshold: float = 0.5, min_words: int = 10, max_repeat_percent: int = 20) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, p_good, kept."""
    spark = docs.sparkSession
    rules = votes()
    rated = stage(spark, features(docs).select("*", *[v.alias(f"v_{k}") for k, v in rules.items()]), "votes")
    names = [f"v_{k}" for k in rules]
    seen = rated.groupBy(*names).agg(F.count("*").alias("n")).collect()  # 3^rules rows at most
    prior, acc = fit(sorted((tuple(r[c] for c in names), r["n"]) for r in seen))
    odds = sum((F.when(F.col(c) > 0, w[0]).when(F.col(c) < 0, w[1]).otherwise(0.0) for c, w in zip(names, weights(acc))),
               F.lit(math.log(prior / (1 - prior))))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    p = 1 / (1 + F.exp(-odds))
    return rated.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        failed.alias("base_failed"), (~failed & (p >= threshold)).alias("kept"), p.alias("p_good"))
