"""The verdict of the quality rules against a document-by-document estimation."""

import collections
import random
import re

import pytest

from sectionmap.llm import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def vote(good, bad):
    return -1 if bad else 1 if good else 0


def rules(text):
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    n, chars = len(words), sum(map(len, words))
    marks, upper = len(re.findall(r"[#*$%&|<>]", text)), len(re.findall(r"[A-Z]", text))
    windows = collections.Counter(tuple(words[i:i + 5]) for i in range(n - 4))
    repeated = len({j for i in range(n - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)})
    dup, part = len(lines) - len(set(lines)), lambda a, b: a / b if b else None
    test = lambda a, f: a is not None and f(a)
    out = (vote(n >= 50, n < 10), vote(marks == 0, test(part(marks, chars), lambda x: x > 0.05)),
           vote(test(part(marks, n), lambda x: x < 0.02), test(part(marks, n), lambda x: x > 0.3)),
           vote(test(part(chars, n), lambda x: 3 <= x <= 10), test(part(chars, n), lambda x: x < 2 or x > 15)),
           vote(test(part(repeated, n), lambda x: x < 0.02), test(part(repeated, n), lambda x: x > 0.2)),
           vote(len(lines) > 1 and dup == 0, test(part(dup, len(lines)), lambda x: x > 0.3)),
           vote(test(part(upper, chars), lambda x: x < 0.1), test(part(upper, chars), lambda x: x > 0.4)),
           vote(n >= 50 and len(set(words)) / n > 0.3, n >= 50 and len(set(words)) / n < 0.1))
    return out, n < 10 or 100 * repeated > 20 * n


def clip(x, low, high):
    return max(low, min(high, x))


def estimate(votes, steps=50):
    """P(good) of each document: probabilities, no logarithms, no grouping of equal votes."""
    prior, good, bad = 0.8, [0.95] * 8, [0.4] * 8

    def belief(v):
        odds = prior / (1 - prior)
        for x, g, b in zip(v, good, bad):
            odds *= 1 if not x else g / (1 - b) if x > 0 else min(1, (1 - g) / b)
        return odds / (1 + odds)

    for _ in range(steps):
        p = [belief(v) for v in votes]
        prior = clip(sum(p) / len(p), 0.05, 0.95)
        cast = [[(q, v[j]) for q, v in zip(p, votes) if v[j]] for j in range(8)]
        good = [clip((sum(q for q, x in c if x > 0) + 0.95) / (sum(q for q, _ in c) + 1), 0.6, 0.995) for c in cast]
        bad = [clip((sum(1 - q for q, x in c if x < 0) + 0.4) / (sum(1 - q for q, _ in c) + 1), 0.05, 0.995) for c in cast]
    return [belief(v) for v in votes]


@pytest.fixture(scope="module")
def mixed_docs():
    rng = random.Random(8)
    prose = lambda n: " ".join(rng.choice(["river", "hills", "of", "the", "land", "survey", "old", "maps", "town"]) + str(rng.randrange(40)) for _ in range(n))
    kinds = [lambda: prose(80), lambda: prose(30) + "\n" + prose(40), lambda: "# * $ % " * 30, lambda: "BUY NOW " * 40, lambda: prose(12), lambda: "x",
             lambda: "same line\n" * 20 + prose(20), lambda: prose(60).upper(), lambda: "a b c " * 40, lambda: "", lambda: "w" * 300,
             lambda: " ".join(f"#{i}$%QZXWV" for i in range(rng.randrange(12, 30)))]
    return [(i, rng.choice(kinds)()) for i in range(160)] + [(500, None)]


def test_kept_is_the_posterior_s_verdict(spark, mixed_docs):
    got = {r["doc_id"]: r for r in quality_rules.judge(spark.createDataFrame(mixed_docs, "doc_id long, text string")).collect()}
    voted = [rules(t or "") for _, t in mixed_docs]
    belief = estimate([v for v, _ in voted])
    for (d, _), (_, failed), p in zip(mixed_docs, voted, belief):
        assert got[d]["base_failed"] == failed and abs(got[d]["p_good"] - p) < 1e-6
        assert got[d]["kept"] == (not failed and p >= 0.5) or abs(p - 0.5) < 1e-6
    kept = [r["kept"] for r in got.values()]
    assert any(kept) and not all(kept) and any(not r["kept"] and not r["base_failed"] for r in got.values())


def test_a_posterior_equal_to_the_threshold_is_kept(spark, mixed_docs):
    docs = spark.createDataFrame(mixed_docs, "doc_id long, text string")
    p = sorted(r["p_good"] for r in quality_rules.judge(docs).collect() if not r["base_failed"])[3]
    got = [r for r in quality_rules.judge(docs, threshold=p).collect() if r["p_good"] == p]
    assert got and all(r["kept"] != r["base_failed"] for r in got)
