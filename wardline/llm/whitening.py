"""Embedding whitening: covariance over all tasks, leading components of it, projection in the rows.

The covariance of the distinct rounded vectors is summed in two levels. Its leading eigenvalues
come from a Householder tridiagonal form by counting sign changes of Sturm sequences, its
components by inverse iteration, orthogonalised within clusters of close eigenvalues. Every row
is then projected where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.llm.base import pick, stored
from wardline.operators.trees import PART, part_row, tree_sum

#: x = floor(SCALE * entry) + SHIFT.
SCALE, SHIFT = 64, 1_000_000

#: A component of a smaller share of the variance cannot be told from rounding.
LEAST_SHARE = 1e-11


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, reflections) of a symmetric matrix turned by Householder reflections.

    Row k of the reflections is the unit vector of the k-th one; the matrix is Q T Q' with Q
    the product of I - 2 v v' in their order.
    """
    a = np.array(matrix, np.float64)
    n = len(a)
    mirrors = np.zeros((max(n - 2, 0), n))
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        scale = np.abs(x).max()
        if scale == 0 or np.abs(x[1:]).max() == 0:
            continue  # nothing below the off-diagonal: the reflection would be the identity
        x /= scale
        x[0] += np.copysign(np.sqrt(x @ x), x[0])
        v = x / np.sqrt(x @ x)
        mirrors[k, k + 1:] = v
        part = a[k + 1:, k + 1:]
        w = part @ v
        w -= v * (v @ w)
        part -= 2 * (np.outer(v, w) + np.outer(w, v))
        head = a[k + 1:, k] - 2 * v * (v @ a[k + 1:, k])
        a[k + 1:, k] = a[k, k + 1:] = head
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def turned_back(mirrors: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Q times a vector."""
    out = vector.copy()
    for v in mirrors[::-1]:
        out -= 2 * v * (v @ out)
    return out


def below(diagonal: np.ndarray, square: np.ndarray, points: np.ndarray, tiny: float) -> np.ndarray:
    """How many eigenvalues lie below each point: negative terms of the Sturm sequence of ratios."""
    count, q = np.zeros(len(points), np.int64), np.ones(len(points))
    for d, s in zip(diagonal, np.append(0.0, square)):
        q = d - points - s / q
        q = np.where(np.abs(q) < tiny, -tiny, q)  # a zero counts as negative, here and in the next ratio
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling, by bisection to the last digits of a double."""
    n = len(diagonal)
    radius = np.append(np.abs(off), 0) + np.append(0, np.abs(off))
    low, high = float((diagonal - radius).min()), float((diagonal + radius).max())
    size = max(abs(low), abs(high), np.finfo(float).tiny)
    tiny, square = np.finfo(float).tiny / np.finfo(float).eps, off * off
    lows, highs = np.full(count, low - 1e-15 * size), np.full(count, high + 1e-15 * size)
    wanted = n - np.arange(count)  # so many eigenvalues lie at or below the one sought
    for _ in range(120):
        middle = (lows + highs) / 2
        above = below(diagonal, square, middle, tiny) >= wanted
        highs, lows = np.where(above, middle, highs), np.where(above, lows, middle)
        if ((highs - lows) <= np.finfo(float).eps * np.maximum(np.abs(highs), 1e-3 * np.finfo(float).eps * size)).all():
            break
    return (lows + highs) / 2


def solved(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, tiny: float) -> np.ndarray:
    """(T - shift) x = right by elimination with row exchanges; a zero pivot becomes tiny."""
    n = len(diagonal)
    main, upper, second, x = diagonal - shift, np.append(off, 0.0), np.zeros(n), right.copy()
    for k in range(n - 1):
        low, mid, high = off[k], main[k + 1], upper[k + 1]
        if abs(main[k]) >= abs(low):
            pivot = main[k] if abs(main[k]) > tiny else tiny
            main[k] = pivot
            m = low / pivot
            main[k + 1] = mid - m * upper[k]
            x[k + 1] -= m * x[k]
        else:
            m = main[k] / low
            main[k], upper_k, upper[k], second[k] = low, upper[k], mid, high
            main[k + 1], upper[k + 1] = upper_k - m * mid, -m * high
            x[k], x[k + 1] = x[k + 1], x[k] - m * x[k + 1]
    for k in range(n - 1, -1, -1):
        pivot = main[k] if abs(main[k]) > tiny else tiny
        x[k] -= (upper[k] * x[k + 1] if k + 1 < n else 0.0) + (second[k] * x[k + 2] if k + 2 < n else 0.0)
        x[k] /= pivot
        if abs(x[k]) > 1e200:
            x /= abs(x[k])
    return x


def components_of(matrix: np.ndarray, count: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns."""
    n = len(matrix)
    count = min(count, n)
    if not count or not np.abs(matrix).max():
        return np.zeros(count), np.eye(n)[:, :count]
    diagonal, off, mirrors = tridiagonal(matrix)
    size = np.abs(matrix).max() * n
    eps = np.finfo(float).eps
    # couplings below rounding are none; a block by itself has eigenvectors of its own
    off = np.where(np.abs(off) <= eps * (np.abs(diagonal[:-1]) + np.abs(diagonal[1:])), 0.0, off)
    values = leading_values(diagonal, off, count)
    draw, vectors = np.random.default_rng(seed), np.zeros((n, count))
    for j, value in enumerate(values):
        # equal eigenvalues are set apart a little, or inverse iteration meets the same vector again
        shift = value - eps * size * sum(1 for k in range(j) if values[k] - value <= 10 * eps * size)
        near = [k for k in range(j) if abs(values[k] - value) <= 1e-3 * size]
        x = draw.normal(size=n)
        for _ in range(6):
            x = solved(diagonal, off, shift, x / np.abs(x).max(), eps * size)
            x /= np.abs(x).max()
            for _ in range(2):
                for k in near:
                    x -= vectors[:, k] * (vectors[:, k] @ x)
            x /= np.sqrt(x @ x)
        vectors[:, j] = x
    back = np.stack([turned_back(mirrors, vectors[:, j]) for j in range(count)], axis=1)
    return values, back


@dataclass(frozen=True)
class Whitener:
    """What a space of vectors of one length needs to be whitened."""

    n: int
    sums: np.ndarray       # d, whole numbers
    turn: np.ndarray       # d x k: components over the roots of their eigenvalues
    explained: np.ndarray  # k
    identity_error: float


def whole(vector_col: str) -> Column:
    """The entries as whole numbers; null where the vector is null or holds a null or non-finite entry."""
    doubles = F.col(vector_col).cast("array<double>")
    fine = F.forall(doubles, lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    return F.when(fine, F.transform(doubles, lambda c: (F.floor(SCALE * c) + SHIFT).cast("long")))


def _matrix(batch: pa.RecordBatch, name: str, dims: int) -> np.ndarray:
    flat = pa.concat_arrays([batch.column(name)]).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dims)


def _moments(rows: DataFrame, dims: int, count: int, of) -> np.ndarray:
    """Sum over all rows of ``of(x)``, an array of ``count`` doubles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(count)
        for batch in batches:
            if batch.num_rows:
                total += of(_matrix(batch, "x", dims))
        yield part_row(TaskContext.get().partitionId(), total)

    return tree_sum(rows.select("x").mapInArrow(run, PART), count)


def fit(vectors: DataFrame, most: int = 16, vector_col: str = "embedding") -> dict[int, Whitener]:
    """A whitener for each length of vectors, over the distinct whole vectors of that length.

    Each length is a space of its own: their number must be small, one fit runs for each. The
    driver holds one length-squared covariance at a time, never a vector of the table.
    """
    x = pick(vectors, vector_col).select(whole(vector_col).alias("x")).where("x IS NOT NULL AND size(x) > 0")
    # copies combine before the shuffle, so a vector in a third of the rows is one row a task
    distinct = stored(x.distinct().withColumn("dims", F.size("x")), "whole")
    counts = {r["dims"]: r["n"] for r in distinct.groupBy("dims").agg(F.count("*").alias("n")).collect()}
    found = {}
    for dims, n in sorted(counts.items()):
        own = distinct.where(F.col("dims") == dims)
        places = own.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("s")).collect()
        sums = np.zeros(dims, np.int64)
        for r in places:
            sums[r["i"]] = r["s"]
        centre = sums / n

        def products(rows: np.ndarray) -> np.ndarray:
            away = rows - centre
            return (away.T @ away).reshape(-1)

        covariance = _moments(own, dims, dims * dims, products).reshape(dims, dims) / n
        covariance = (covariance + covariance.T) / 2
        trace = float(np.trace(covariance))
        values, axes = components_of(covariance, most)
        good = values > LEAST_SHARE * trace
        values, turn = values[good], axes[:, good] / np.sqrt(values[good])
        k = len(values)
        if not k:
            found[dims] = Whitener(n, sums, turn, values, 0.0)
            continue
        mean = _moments(own, dims, k, lambda rows: ((rows - centre) @ turn).sum(axis=0)) / n

        def whitened(rows: np.ndarray) -> np.ndarray:
            away = (rows - centre) @ turn - mean
            return (away.T @ away).reshape(-1)

        check = _moments(own, dims, k * k, whitened).reshape(k, k) / n
        found[dims] = Whitener(n, sums, turn, values / trace, float(np.abs(check - np.eye(k)).max()))
    return found


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Sum over dimensions of (n x - S) squared, exact; null where that is no long."""
    rough = ((x.astype(np.float64) * n - sums) ** 2).sum(axis=1)
    small = rough < 2.0 ** 62
    away = np.where(small[:, None], x, 0) * np.int64(n) - np.where(small[:, None], sums, 0)
    exact = (away * away).sum(axis=1).tolist()
    for r in np.flatnonzero(~small).tolist():
        total = sum((n * a - s) ** 2 for a, s in zip(x[r].tolist(), sums.tolist()))
        exact[r] = total if total < 1 << 63 else None
    return pa.array(exact, pa.int64())


def whiten(vectors: DataFrame, most: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector and component: id, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Rows whose vector is null or holds a null or non-finite entry are left out, and empty vectors
    have no component. Null and repeated ids pass through, every row is projected; copies of a
    vector count once in the fit. Vectors of another length are a space of their own. A component
    with less than ``LEAST_SHARE`` of the variance is not returned (a space of one distinct vector
    has none), since its direction is rounding alone. Among equal eigenvalues any orthonormal
    components may come, the same ones for all rows. ``deviation`` is null where it exceeds a
    long; entries beyond some 1e17 overflow the whole numbers and raise. Other columns are not
    read; an empty table gives an empty one.
    """
    rows = pick(vectors, id_col, vector_col)
    spaces = fit(rows, most, vector_col)
    schema = T.StructType([rows.schema[0], *[T.StructField(n, t) for n, t in (
        ("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()), ("whitened", T.DoubleType()),
        ("explained", T.DoubleType()), ("identity_error", T.DoubleType()))]])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("dims").to_numpy(zero_copy_only=False)
            for dims in np.unique(sizes).tolist():
                space = spaces[dims]
                k, own = len(space.explained), batch.take(pa.array(np.flatnonzero(sizes == dims)))
                step = max((1 << 20) // max(dims, 16), 1)
                for a in range(0, own.num_rows if k else 0, step):
                    part = own.slice(a, step)
                    x, m = _matrix(part, "x", dims), part.num_rows
                    again = pa.array(np.repeat(np.arange(m), k))
                    yield pa.RecordBatch.from_arrays([
                        part.column(0).take(again), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, space.n)), deviations(x, space.n, space.sums).take(again),
                        pa.array(((x - space.sums / space.n) @ space.turn).reshape(-1)),
                        pa.array(np.tile(space.explained, m)), pa.array(np.full(m * k, space.identity_error))],
                        names=schema.names)

    usable = rows.select(id_col, whole(vector_col).alias("x")).where("x IS NOT NULL AND size(x) > 0")
    return usable.withColumn("dims", F.size("x")).mapInArrow(project, schema)
