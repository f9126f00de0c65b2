"""Embedding whitening from variances alone (polarisation).

Cov(a, b) = (Var(a + b) - Var(a) - Var(b)) / 2, so the covariance matrix follows
from the squared centred values of every dimension and of every sum of two
dimensions.  Each entry c becomes the integer floor(scale * c) + shift; a vector
counts once however often it occurs.  With n vectors and sums S, u = n * x - S is
the centred value times n, an integer: the sums of u_i^2 and (u_i + u_j)^2 are exact
(64-bit limbs in the tasks, decimals in Spark), the cross-covariances are exact
fractions, and only their quotient by n^3 is rounded, once.  ``eigh`` of that matrix
(dimensions squared, the only thing that reaches the driver) gives the components.

Spark does the distinct (map-side first, so a hot vector is one row a task), the
sums per task and their totals; no vector list is ever gathered.

Defined cases: a null vector, one with a null or non-finite entry, an entry beyond
+-2^40 / scale and a vector of another length than the most frequent one (of equal ones
the longest) have no result rows.  Components without variance (an eigenvalue of at most
``RELATIVE_ZERO`` times the largest) are not returned: a single distinct vector has none.
Repeated rows stay; an empty table gives an empty result.  Spans of n * x that
need more than 58 bits, and a ``deviation`` beyond 64 bits, are errors, never wrong figures.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, IntegerType, LongType, StructField, StructType

from sectionmap.llm.common import stage

SCALE, SHIFT = 64, 1_000_000
RELATIVE_ZERO = 1e-13
#: Rows that one step of the tasks holds as a matrix.
ROWS = 2048


@dataclass
class Whitening:
    n: int
    sums: list[int]
    vectors: np.ndarray  # one unit eigenvector a column, by falling eigenvalue
    values: np.ndarray
    trace: float
    identity_error: float

    @property
    def dims(self) -> int:
        return len(self.sums)


def integer_vectors(rows: DataFrame, vector: str, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``rows`` with usable vectors and the integers of each as ``__x``."""
    entries = F.col(vector).cast("array<double>")
    most = float(1 << 40)
    usable = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * F.lit(float(scale))) < most))
    return (rows.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & usable)
            .withColumn("__x", F.transform(entries, lambda c: F.floor(c * F.lit(float(scale))) + F.lit(shift))))


def matrix(column: pa.Array, dims: int) -> Iterator[np.ndarray]:
    """The vectors of a list column as integer matrices of at most ``ROWS`` rows."""
    for first in range(0, len(column), ROWS):
        flat = column.slice(first, ROWS).flatten()
        yield np.asarray(flat.to_numpy(zero_copy_only=False), np.int64).reshape(-1, dims)


def _totals(fit: DataFrame, dims: int, add: Callable[[dict, np.ndarray], None], keys: Sequence[str], kinds: str, how: Sequence) -> list:
    """Rows of (keys, totals): ``add`` collects the sums of a task in a dict of
    key -> list, Spark adds up the tasks'."""
    names = [f"v{i}" for i in range(len(how))]
    # Integer totals travel as text, so that no width is lost on the way.
    schema = StructType([StructField(k, IntegerType()) for k in keys] + [StructField(v, _kind(kinds)) for v in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}
        for batch in batches:
            for x in matrix(batch.column(0), dims):
                add(found, x)
        if found:
            columns = list(zip(*found.keys()))
            values = list(zip(*found.values()))
            arrow = pa.float64() if kinds == "double" else pa.decimal128(38, 0)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int32()) for c in columns),
                 *(pa.array([_exact(v) if kinds != "double" else v for v in vs], arrow) for vs in values)], names=schema.names)

    return fit.select("__x").mapInArrow(run, schema).groupBy(*keys).agg(*[f(v).alias(v) for f, v in zip(how, names)]).collect()


def _kind(kinds: str):
    return DoubleType() if kinds == "double" else DecimalType(38, 0)


def _exact(v: int):
    from decimal import Decimal
    return Decimal(int(v))


def learn(rows: DataFrame, vector: str = "embedding", scale: int = SCALE, shift: int = SHIFT, components: int = 16) -> Whitening | None:
    """The components of the distinct usable vectors; None when there are none."""
    fit = stage(rows.sparkSession, integer_vectors(rows.select(vector), vector, scale, shift).select("__x").distinct(), "vectors")
    lengths = fit.groupBy(F.size("__x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).head(1)
    if not lengths:
        return None
    dims = lengths[0]["dims"]
    fit = fit.where(F.size("__x") == dims)

    def sums(found: dict, x: np.ndarray) -> None:
        for i, (s, low, high) in enumerate(zip(x.sum(0), x.min(0), x.max(0))):
            old = found.setdefault((i,), [0, 0, int(low), int(high)])
            found[(i,)] = [old[0] + len(x), old[1] + int(s), min(old[2], int(low)), max(old[3], int(high))]

    firsts = sorted(_totals(fit, dims, sums, ["i"], "exact", [F.sum, F.sum, F.min, F.max]))
    n, total = int(firsts[0]["v0"]), [int(r["v1"]) for r in firsts]
    spread = max(max(abs(n * int(r["v2"]) - s), abs(n * int(r["v3"]) - s)) for r, s in zip(firsts, total))
    bits = (2 * spread).bit_length()
    if bits > 58 or max(abs(n * int(r[f"v{k}"])) for r in firsts for k in (2, 3)) >= 1 << 62:
        raise OverflowError(f"centred values of {bits} bits: use a smaller scale")
    squares = polarised(fit, dims, n, total, bits)
    covariance = assemble(squares, dims, n)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")
    order = order[values[order] > RELATIVE_ZERO * max(values.max(), 0.0)][:components]
    model = Whitening(n, total, vectors[:, order], values[order], float(np.trace(covariance)), 0.0)
    model.identity_error = check_identity(fit, model)
    return model


def polarised(fit: DataFrame, dims: int, n: int, total: Sequence[int], bits: int) -> dict[tuple[int, int], int]:
    """(i, i) -> sum of u_i^2, (i, j) -> sum of (u_i + u_j)^2 for i < j, over u = n * x - S.

    A value of ``bits`` bits is cut in two limbs; as many rows are added up in
    64 bits as cannot overflow, the rest is done in integers of any size."""
    half = (bits + 1) // 2
    step = int(max(1, min(ROWS, 1 << (61 - 2 * half))))

    def squared(s: np.ndarray) -> list[int]:
        high, low = s >> half, s & ((1 << half) - 1)
        out = [0] * s.shape[1]
        for k, (a, b) in ((2 * half, (high, high)), (half + 1, (high, low)), (0, (low, low))):
            for j, v in enumerate(np.einsum("ij,ij->j", a, b).tolist()):
                out[j] += v << k
        return out

    def add(found: dict, x: np.ndarray) -> None:
        u = x * n - np.array(total, np.int64)
        for first in range(0, len(u), step):
            part = u[first:first + step]
            for i in range(dims):
                pairs = np.concatenate([part[:, i:i + 1], part[:, i:i + 1] + part[:, i + 1:]], axis=1)
                for j, v in enumerate(squared(pairs), i):
                    found.setdefault((i, j), [0])[0] += v

    return {(r["i"], r["j"]): int(r["v0"]) for r in _totals(fit, dims, add, ["i", "j"], "exact", [F.sum])}


def assemble(squares: dict[tuple[int, int], int], dims: int, n: int) -> np.ndarray:
    """The covariance matrix (divisor n) from the squares of single dimensions and of pair sums."""
    out = np.zeros((dims, dims))
    cube = n ** 3
    for (i, j), v in squares.items():
        cross = v if i == j else (v - squares[i, i] - squares[j, j]) // 2
        out[i, j] = out[j, i] = cross / cube
    return out


def project(x: np.ndarray, model: Whitening) -> np.ndarray:
    """Centred and projected on the components, over the square root of their variance."""
    centred = (x * model.n - np.array(model.sums, np.int64)) / model.n
    return centred @ model.vectors / np.sqrt(model.values)


def check_identity(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened covariance over the fit list minus the identity."""
    k = len(model.values)

    def add(found: dict, x: np.ndarray) -> None:
        w = project(x, model)
        products = w.T @ w
        for i in range(k):
            for j in range(i, k):
                found.setdefault((i, j), [0.0])[0] += float(products[i, j])

    cells = _totals(fit, model.dims, add, ["i", "j"], "double", [F.sum])
    return max((abs(r["v0"] / model.n - (r["i"] == r["j"])) for r in cells), default=0.0)


def whiten(rows: DataFrame, model: Whitening | None, keep: Sequence[str] = ("vec_id",), vector: str = "embedding",
           scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``keep`` columns, component (from 1), deviation (sum of squares of n * x - S, exact)
    and whitened value: one row for each usable vector and component."""
    usable = integer_vectors(rows.select(*dict.fromkeys([*keep, vector])), vector, scale, shift)
    usable = usable.where(F.size("__x") == (model.dims if model else 0)).select(*keep, "__x")
    schema = StructType(usable.schema.fields[:-1])
    for name, kind in (("component", IntegerType()), ("deviation", LongType()), ("whitened", DoubleType())):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        for batch in batches:
            first = 0
            for x in matrix(batch.column(batch.num_columns - 1), model.dims):
                u = x * model.n - np.array(model.sums, np.int64)
                big = int(np.abs(u).max()) ** 2 * model.dims >= 1 << 62
                # Beyond 64 bits the integers are exact and Arrow refuses what does not fit a long.
                deviation = [sum(v * v for v in r) for r in u.tolist()] if big else (u * u).sum(1)
                at = np.repeat(np.arange(first, first + len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(pa.array(at)) for c in batch.columns[:-1]), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(deviation, pa.int64()).take(pa.array(at - first)), pa.array(project(x, model).reshape(-1))], names=schema.names)
                first += len(x)

    return usable.mapInArrow(run, schema) if model else usable.drop("__x").where(F.lit(False)).select(
        *keep, *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields[len(keep):]])
