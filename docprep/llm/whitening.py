"""Whitening of embeddings: the leading components of their covariance, scaled to variance one.

Tasks sum the vectors, centre them and add up their products; one matrix of
d x d numbers comes to the driver, where d is the length of a vector and not
the number of rows. There it is made tridiagonal by Householder reflections,
its leading eigenvalues are found by bisection on Sturm counts, and their
eigenvectors by inverse iteration, orthogonalised anew within clusters of close
values. The components, d numbers each, go out to the tasks, which project.

Vectors are whole numbers, and they are centred by the mean rounded to whole
numbers, so sums and products are exact whatever the order of tasks; what the
rounding leaves is taken off exactly when the matrix is divided by n. So the
result doesn't depend on how rows are dealt.

Edge cases: see ``vectors.whole_vectors`` for vectors that take no part; a null
id stays; repeated rows count as often as they stand there; an empty table gives
no rows. A component without variance (as with equal vectors, or fewer vectors
than components) has ``whitened`` null and explains nothing. ``deviation`` is
null where it is too large for a long. Vectors of fewer than ``K`` entries have as many
components as entries. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .vectors import matrix, whole_vectors

K, SHIFT = 8, 100_000
EPS = float(np.finfo(float).eps)
#: Eigenvalues nearer than this share of the largest are a cluster.
CLUSTER = 1e-3
_SUM = pa.decimal128(38, 0)


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, q) with a = q t q'; a is symmetric."""
    a, d = a.astype(float).copy(), len(a)
    q = np.eye(d)
    for k in range(d - 2):
        x = a[k + 1 :, k]
        size = float(np.max(np.abs(x[1:]), initial=0.0))
        if size == 0:
            continue
        size = max(size, abs(float(x[0])))
        norm = size * float(np.sqrt(np.sum((x / size) ** 2)))
        v = x / norm
        v[0] += 1.0 if v[0] >= 0 else -1.0
        v /= np.sqrt(v @ v)
        rest = a[k + 1 :, k + 1 :]
        w = rest @ v
        w -= (v @ w) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] = 0
        a[k + 1, k] = -norm if v[0] > 0 else norm
        a[k, k + 1 :] = a[k + 1 :, k]
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each of ``at`` the number of eigenvalues below it: negative pivots of the shifted matrix."""
    tiny = np.finfo(float).tiny
    below, pivot = np.zeros(len(at), int), np.ones(len(at))
    for k, a in enumerate(diagonal):
        pivot = a - at - (off[k - 1] ** 2 / pivot if k else 0.0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        below += pivot < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection until no double lies between the bounds."""
    d = len(diagonal)
    reach = np.concatenate([[0.0], np.abs(off)]) + np.concatenate([np.abs(off), [0.0]])
    pad = 4 * EPS * float(np.max(np.abs(diagonal) + reach)) + np.finfo(float).tiny
    low, high = np.full(k, np.min(diagonal - reach) - pad), np.full(k, np.max(diagonal + reach) + pad)
    place = d - 1 - np.arange(k)  # of the ascending values
    while True:
        middle = low + (high - low) / 2
        if np.all((middle <= low) | (middle >= high)):
            return middle
        above = sturm_counts(diagonal, off, middle) > place
        high, low = np.where(above, middle, high), np.where(above, low, middle)


def _solver(diagonal: np.ndarray, off: np.ndarray, shift: float, least: float):
    """Solves (t - shift) y = b by elimination with row exchanges; pivots below ``least`` are raised to it."""
    d = len(diagonal)
    a, up, up2 = (diagonal - shift).tolist(), [*off.tolist(), 0.0], [0.0] * d
    steps = []
    for k in range(d - 1):
        low, nxt, after = float(off[k]), a[k + 1], up[k + 1]
        swap = abs(low) > abs(a[k])
        if swap:
            a[k], low, up[k], nxt, up2[k], after = low, a[k], nxt, up[k], after, 0.0
        if abs(a[k]) < least:
            a[k] = least if a[k] >= 0 else -least
        f = low / a[k]
        a[k + 1], up[k + 1] = nxt - f * up[k], after - f * up2[k]
        steps.append((swap, f))
    if abs(a[-1]) < least:
        a[-1] = least if a[-1] >= 0 else -least

    def solve(b: np.ndarray) -> np.ndarray:
        y = b.tolist()
        for k, (swap, f) in enumerate(steps):
            if swap:
                y[k], y[k + 1] = y[k + 1], y[k]
            y[k + 1] -= f * y[k]
        for k in range(d - 1, -1, -1):
            y[k] = (y[k] - (up[k] * y[k + 1] if k + 1 < d else 0.0) - (up2[k] * y[k + 2] if k + 2 < d else 0.0)) / a[k]
        return np.array(y)

    return solve


def vectors_of(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix, a row for each of ``values`` (falling)."""
    d = len(diagonal)
    norm = float(np.max(np.abs(diagonal) + np.concatenate([[0.0], np.abs(off)]) + np.concatenate([np.abs(off), [0.0]])))
    found: list[np.ndarray] = []
    first, shift = 0, 0.0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            first = k
        shift = min(float(value), shift - 4 * EPS * norm) if k > first else float(value)
        solve = _solver(diagonal, off, shift, max(EPS * norm, np.finfo(float).tiny))
        y = np.random.default_rng(k).uniform(0.5, 1.0, d) * np.where(np.arange(d) % (k + 2) == 0, -1, 1)
        for _ in range(6):
            y = y / np.max(np.abs(y))
            y = solve(y / np.sqrt(y @ y))
            y = y / np.max(np.abs(y))
            for _again in range(2):
                for other in found[first:]:
                    y = y - (other @ y) * other
            y = y / np.sqrt(y @ y)
        found.append(y)
    return np.array(found)


def leading_components(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as rows; the largest entry of each is positive."""
    diagonal, off, q = tridiagonal(a)
    values = leading_values(diagonal, off, k)
    rows = vectors_of(diagonal, off, values) @ q.T
    rows /= np.sqrt(np.sum(rows**2, axis=1, keepdims=True))
    return values, rows * np.where(rows[np.arange(k), np.argmax(np.abs(rows), axis=1)] < 0, -1.0, 1.0)[:, None]


@dataclass(frozen=True)
class Whitening:
    """n vectors with sums S, and the components of their covariance. usable: how many components have variance."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    usable: int

    @property
    def middle(self) -> np.ndarray:
        """The mean, rounded to whole numbers."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], dtype=np.int64)


def _sums(vectors: DataFrame, d: int, of: str) -> dict[tuple[int, int], int]:
    """Sums over all vectors of entries (i, -1), and the count at (-1, -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, dtype=object)
        for batch in batches:
            if batch.num_rows:
                n += batch.num_rows
                total = total + (matrix(batch, d) >> 26).sum(axis=0).astype(object) * (1 << 26) + (matrix(batch, d) & ((1 << 26) - 1)).sum(axis=0).astype(object)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([-1, *range(d)], pa.int32()), pa.array([n, *total.tolist()], _SUM)], names=["i", "s"])

    return {r["i"]: int(r["s"]) for r in vectors.mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").cast("decimal(38,0)").alias("s")).collect()}


def products(z: np.ndarray) -> np.ndarray:
    """z'z of an integer matrix, exact, as Python's integers; by floating point where it is exact."""
    top = int(np.max(np.abs(z), initial=0))
    if top >= 1 << 26:
        big = z.astype(object)
        return big.T @ big
    out, rows = np.zeros((z.shape[1],) * 2, dtype=object), max(1, (1 << 53) // max(1, top * top))
    for at in range(0, len(z), rows):
        part = z[at : at + rows].astype(float)
        out = out + (part.T @ part).astype(np.int64).astype(object)
    return out


def fit(vectors: DataFrame, d: int, k: int = K) -> Whitening | None:
    """vectors: _x, of d entries each. None if there are none."""
    sums = _sums(vectors, d, "x") if d else {}
    if not sums:
        return None
    n, total = sums[-1], [sums[i] for i in range(d)]
    middle = Whitening(n, total, np.zeros(0), np.zeros(0), 0.0, 0).middle
    pairs = list(combinations_with_replacement(range(d), 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = np.zeros((d, d), dtype=object)
        for batch in batches:
            if batch.num_rows:
                made = made + products(matrix(batch, d) - middle)
        rows = [(i, j, made[i, j]) for i, j in pairs if made[i, j]]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], _SUM)], names=["i", "j", "s"])

    left = [s - n * int(m) for s, m in zip(total, middle, strict=True)]
    cov = np.zeros((d, d))
    for i in range(d):
        for j in range(d):
            cov[i, j] = -left[i] * left[j] / (n * n)
    for r in vectors.mapInArrow(run, "i int, j int, s decimal(38,0)").groupBy("i", "j").agg(F.sum("s").cast("decimal(38,0)").alias("s")).collect():
        i, j = r["i"], r["j"]
        cov[i, j] = cov[j, i] = (n * int(r["s"]) - left[i] * left[j]) / (n * n)
    k = min(k, d)
    values, components = leading_components(cov, k)
    least = d * EPS * max(float(values[0]), 0.0)
    return Whitening(n, total, values, components, float(np.trace(cov)), int(np.sum(values > least)))


def project(vectors: DataFrame, d: int, model: Whitening) -> DataFrame:
    """_id, deviation, and the array ``w`` of a vector's whitened components; those without variance are left out."""
    n, middle = model.n, model.middle
    left = np.array([s - n * int(m) for s, m in zip(model.sums, middle, strict=True)], dtype=object)
    onto = (model.components[: model.usable] / np.sqrt(model.values[: model.usable])[:, None]).T
    rest = np.array([x / n for x in left], dtype=float)

    def deviations(z: np.ndarray) -> list[int | None]:
        reach = n * (int(np.max(np.abs(z), initial=0)) + 1)
        if d * reach * reach < 1 << 63:
            return np.sum((n * z - left.astype(np.int64)) ** 2, axis=1).tolist()
        exact = np.sum((n * z.astype(object) - left) ** 2, axis=1).tolist()
        return [x if x < 1 << 63 else None for x in exact]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                z = matrix(batch, d) - middle
                w = (z.astype(float) - rest) @ onto
                yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(deviations(z), pa.int64()), pa.array(list(w), pa.list_(pa.float64()))], names=["_id", "deviation", "w"])

    return vectors.mapInArrow(run, "_id long, deviation long, w array<double>")


def identity_error(projected: DataFrame, k: int) -> float:
    """The largest absolute entry of the covariance of w less the identity; centred before multiplying."""
    if not k:
        return 0.0
    w = [F.col("w")[i] for i in range(k)]
    means = projected.agg(*(F.avg(c).alias(f"m{i}") for i, c in enumerate(w))).first()
    pairs = list(combinations_with_replacement(range(k), 2))
    cov = projected.agg(*(F.avg((w[i] - means[i]) * (w[j] - means[j])).alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(cov[n] - (i == j)) for n, (i, j) in enumerate(pairs))


def whiten_embeddings(df: DataFrame, k: int = K) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each vector and component."""
    vectors, d = whole_vectors(df, SHIFT)
    model = fit(vectors, d, k)
    if model is None:
        return df.sparkSession.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    made = written(project(vectors, d, model), "whitened")
    error = identity_error(made, model.usable)
    share = F.array(*(F.lit(float(v) / model.trace if i < model.usable else 0.0) for i, v in enumerate(model.values)))
    numbered = made.select("_id", "deviation", "w", F.explode(F.sequence(F.lit(1), F.lit(len(model.values)))).alias("component"))
    return numbered.select(
        F.col("_id").alias("vec_id"), "component", F.lit(model.n).cast("long").alias("n"), "deviation", F.get("w", F.col("component") - 1).alias("whitened"),
        F.get(share, F.col("component") - 1).alias("explained"), F.lit(error).alias("identity_error"),
    )
