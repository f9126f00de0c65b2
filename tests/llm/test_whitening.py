"""Whitening against exact arithmetic on the driver."""

import math
from fractions import Fraction

import numpy as np
import pytest

from sectionmap.llm import whitening

SCHEMA = "vec_id long, vector array<float>, n string, component string, `__y` int"


def rows_of(spark, vectors):
    return spark.createDataFrame([(i if i != 3 else None, v, "a", "b", 0) for i, v in enumerate(vectors)], SCHEMA)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(7)
    mixed = rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6))
    out = [[float(np.float32(c)) for c in v] for v in mixed]
    out += [out[5]] * 150 + [out[7], [float(np.float32(c + 1e-6)) for c in out[8]]]
    return [*out, None, [], [None] * 6, [1.0, float("nan"), *[0.0] * 4], [float("inf"), *[0.0] * 5],
                  [1.0, 2.0], [3e38, *[0.0] * 5]]


def usable(vectors):
    good = [v for v in vectors if v and len(v) == 6 and all(c is not None and math.isfinite(c) and abs(c) < 1e30 for c in v)]
    return [[math.floor(64 * c) + 1_000_000 for c in v] for v in good]


def brute(vectors, k):
    xs = usable(vectors)
    fit = sorted({tuple(x) for x in xs})
    n, dims = len(fit), len(fit[0])
    sums = [sum(x[i] for x in fit) for i in range(dims)]
    cov = np.array([[float(Fraction(sum((n * x[i] - sums[i]) * (n * x[j] - sums[j]) for x in fit), n ** 3)) for j in range(dims)] for i in range(dims)])
    values, parts = np.linalg.eigh(cov)
    values, parts = values[::-1][:k], parts[:, ::-1][:, :k]
    out = []
    for x in xs:
        centred = np.array([float(Fraction(n * c - s, n)) for c, s in zip(x, sums)])
        out.append((sum((n * c - s) ** 2 for c, s in zip(x, sums)), centred @ parts / np.sqrt(values)))
    return n, values / np.trace(cov), out


@pytest.mark.parametrize("k", [4, 16])
def test_whitening(spark, vectors, k):
    rows = rows_of(spark, vectors)
    model = whitening.learn(rows, "vector", components=k)
    n, share, want = brute(vectors, k)
    assert model.n == n and model.identity_error < 1e-9
    assert np.allclose(np.array(model.values) / model.trace, share, rtol=1e-10)
    got = whitening.whiten(rows, model, keep=("vec_id", "n"), vector="vector").collect()
    kept = min(k, 6)
    assert len(got) == len(want) * kept and {r["component"] for r in got} == set(range(1, kept + 1))
    ids = [i if i != 3 else None for i, v in enumerate(vectors) if usable([v])]
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    signs = np.sign([by[ids[0]][c + 1]["whitened"] * want[0][1][c] for c in range(kept)])
    for i, (deviation, values) in zip(ids, want):
        assert all(by[i][c]["deviation"] == deviation for c in by[i])
        assert np.allclose([by[i][c + 1]["whitened"] for c in range(kept)], signs * values, atol=1e-8)


def test_pair_sums_give_the_covariance(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(-10**9, 10**9, (200, 3))
    fit = spark.createDataFrame([([int(c) for c in v],) for v in x], "__x array<long>")
    total = [int(s) for s in x.sum(0)]
    n = len(x)
    u = [[n * int(c) - s for c, s in zip(v, total)] for v in x]
    for bits in (2 * max(abs(c) for v in u for c in v)).bit_length(), 58:
        squares = whitening.polarised(fit, 3, n, total, bits)
        assert squares == {(i, j): sum((v[i] + (v[j] if i != j else 0)) ** 2 for v in u) for i in range(3) for j in range(i, 3)}
    want = [[float(Fraction(sum(v[i] * v[j] for v in u), n ** 3)) for j in range(3)] for i in range(3)]
    assert whitening.assemble(squares, 3, n).tolist() == want


def test_entries_too_far_apart_are_an_error(spark):
    rows = rows_of(spark, [[float(1 << 33), 0.0], [0.0, 1.0]] * 3 + [[float(i), 2.0] for i in range(1 << 12)])
    model = whitening.learn(rows, "vector")
    with pytest.raises(Exception):
        whitening.whiten(rows, model, vector="vector").collect()


@pytest.mark.parametrize("vectors", [[], [None, []], [[1.0, 2.0]] * 5])
def test_nothing_to_whiten(spark, vectors):
    rows = rows_of(spark, vectors)
    model = whitening.learn(rows, "vector")
    got = whitening.whiten(rows, model, vector="vector")
    assert got.columns == ["vec_id", "component", "deviation", "whitened"] and got.count() == 0


def test_dimension_without_variance(spark):
    rows = rows_of(spark, [[float(i), float(i % 7), 1.0] for i in range(50)])
    model = whitening.learn(rows, "vector")
    assert len(model.values) == 2 and model.identity_error < 1e-9
    assert whitening.whiten(rows, model, vector="vector").count() == 100
