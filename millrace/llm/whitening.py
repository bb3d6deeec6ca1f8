"""Whitening of embeddings: exact distributed covariance, leading components by tridiagonalisation, projection."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.staging import free_name, opened, shipped

SCALE, OFFSET = 1024, 100_000
#: entries beyond this size have no place among embeddings and count as non-finite, so that exact sums fit 38 digits
MAX_ENTRY = float(1 << 40)
COMPONENTS = 8
#: components of less variance than this share of the first are rounding noise of the covariance
LEAST_SHARE = 1e-10
ROUNDS = 5
MAX_BISECTIONS = 200
BLOCK_ROWS = 4096
DECIMAL = pa.decimal128(38, 0)


# --- exact integers of rows -----------------------------------------------------------------


def scaled_rows(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, scaled integers as a matrix) for each length of the usable vectors of a column."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    values = pc.fill_null(flat, np.nan).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))])[:-1]
    for length in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == length)
        matrix = values[starts[rows][:, None] + np.arange(length)]
        with np.errstate(invalid="ignore"):
            good = (np.abs(matrix) <= MAX_ENTRY).all(axis=1)
        if good.any():
            yield rows[good], np.floor(matrix[good] * SCALE).astype(np.int64) + OFFSET


def _most(matrix: np.ndarray) -> int:
    return int(np.abs(matrix).max()) if matrix.size else 0


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], type=DECIMAL)


def _dimension_and_sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """Rows and per-dimension sums of the vectors of the most frequent length (of equally many, the longer)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for rows, x in scaled_rows(batch.column(0)):
                k = x.shape[1]
                part = x.sum(axis=0) if _most(x) < (1 << 62) // len(x) else x.astype(object).sum(axis=0)
                counts[k] = counts.get(k, 0) + len(rows)
                sums[k] = sums.get(k, 0) + part.astype(object)
        for k, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * k, pa.int32()), pa.array(range(k), pa.int32()), pa.array([counts[k]] * k, pa.int64()), _decimals(total)],
                names=["length", "i", "n", "total"])

    parts = vectors.mapInArrow(run, "length int, i int, n long, total decimal(38,0)")
    by_dimension = parts.groupBy("length", "i").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"))
    # one row a length, each with as many numbers as the length
    best = (by_dimension.groupBy("length").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("i", "total"))).alias("sums"))
            .orderBy(F.desc("n"), F.desc("length")).limit(1).collect())
    return (best[0]["n"], [int(s["total"]) for s in best[0]["sums"]]) if best else (0, [])


def _products(z: np.ndarray) -> np.ndarray:
    """``z.T @ z`` in exact integers; by floating-point blocks while all their sums stay below 2**53."""
    most = max(_most(z), 1)
    rows = (1 << 53) // (most * most)
    if not rows:
        wide = z.astype(object)
        return wide.T @ wide
    out = 0
    for at in range(0, len(z), min(rows, BLOCK_ROWS)):
        f = z[at: at + min(rows, BLOCK_ROWS)].astype(np.float64)
        out = out + (f.T @ f).astype(np.int64).astype(object)
    return out


def _centred_products(vectors: DataFrame, pivot: list[int]) -> list[list[int]]:
    """Exact sums of the products of entries centred at ``pivot``: d (d + 1) / 2 rows come to the driver."""
    spark, d = vectors.sparkSession, len(pivot)
    sent = shipped(spark, pivot)
    upper = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, total = np.array(opened(sent), dtype=np.int64), None
        for batch in batches:
            for _, x in scaled_rows(batch.column(0)):
                if x.shape[1] == d:
                    part = _products(x - centre)
                    total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), _decimals(total[upper])], names=["i", "j", "total"])

    parts = vectors.mapInArrow(run, "i int, j int, total decimal(38,0)")
    out = [[0] * d for _ in range(d)]
    for i, j, total in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        out[i][j] = out[j][i] = int(total)
    return out


# --- leading eigenvectors of a symmetric matrix that fits the driver ------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """Diagonal, off-diagonal and reflectors of Householder's similarity transformation."""
    a, reflectors = matrix.copy(), []
    n = len(a)
    off = np.zeros(max(n - 1, 0))
    for k in range(n - 1):
        x = a[k + 1:, k]
        if not np.any(x[1:]):
            off[k] = x[0]
            reflectors.append(None)
            continue
        off[k] = -np.copysign(np.linalg.norm(x), x[0])
        v = x.copy()
        v[0] -= off[k]
        v /= np.linalg.norm(v)
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        reflectors.append(v)
    return np.diag(a).copy(), off, reflectors


def count_below(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray, least: float) -> np.ndarray:
    """Eigenvalues below each shift: negative pivots of the Sturm sequence."""
    squares = np.concatenate([[0.0], off * off])
    pivot, count = np.ones(len(shifts)), np.zeros(len(shifts), dtype=np.int64)
    for a, b in zip(diagonal, squares):
        pivot = a - shifts - b / pivot
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        count += pivot < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest, falling, each bisected until its interval has no number inside."""
    reach = np.concatenate([[0.0], np.abs(off)]) + np.concatenate([np.abs(off), [0.0]])
    size = max(float(np.max(np.abs(diagonal) + reach)), np.finfo(float).tiny)
    least = np.finfo(float).eps * np.finfo(float).eps * size
    wanted = len(diagonal) - 1 - np.arange(k)
    low, high = np.full(k, (diagonal - reach).min() - 1e-12 * size), np.full(k, (diagonal + reach).max() + 1e-12 * size)
    for _ in range(MAX_BISECTIONS):
        middle = (low + high) / 2
        if np.all((middle <= low) | (middle >= high)):
            break
        under = count_below(diagonal, off, middle, least) > wanted
        low, high = np.where(under, low, middle), np.where(under, middle, high)
    return (low + high) / 2


def solved(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """Solution of (T - shift) x = right by elimination with row exchanges; vanishing pivots become ``least``."""
    n = len(diagonal)
    rows = []  # of the triangular factor: pivot and the two entries right of it, with the right side
    a, b, c, r = diagonal[0] - shift, off[0] if n > 1 else 0.0, 0.0, right[0]
    for i in range(1, n):
        below, a2, b2, r2 = off[i - 1], diagonal[i] - shift, off[i] if i < n - 1 else 0.0, right[i]
        if abs(below) > abs(a):
            rows.append((below, a2, b2, r2))
            f = a / below
            a, b, r = b - f * a2, c - f * b2, r - f * r2
        else:
            a = a if abs(a) > least else least
            rows.append((a, b, c, r))
            f = below / a
            a, b, r = a2 - f * b, b2 - f * c, r2 - f * r
        c = 0.0
    rows.append((a if abs(a) > least else least, 0.0, 0.0, r))
    x = np.zeros(n + 2)
    for i in range(n - 1, -1, -1):
        a, b, c, r = rows[i]
        x[i] = (r - b * x[i + 1] - c * x[i + 2]) / a
        if abs(x[i]) > 1e200:  # keeps a nearly singular system within range
            x /= abs(x[i])
            rows[:i] = [(a, b, c, r * 1e-200) for a, b, c, r in rows[:i]]
    return x[:n]


def tridiagonal_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors for the falling ``values`` by inverse iteration; those of a cluster are kept orthogonal."""
    n, eps = len(diagonal), np.finfo(float).eps
    size = max(float(np.max(np.abs(diagonal))), float(np.max(np.abs(off), initial=0.0)), np.finfo(float).tiny)
    start = np.random.default_rng(42)
    out = np.zeros((n, len(values)))
    first, shift = 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * size:
            first = j  # a new cluster
        shift = min(value, shift - 10 * eps * size) if j > first else value
        x = start.standard_normal(n)
        for _ in range(ROUNDS):
            for _ in range(2):
                x -= out[:, first:j] @ (out[:, first:j].T @ x)
            x = solved(diagonal, off, shift, x / np.linalg.norm(x), eps * size)
            x /= np.max(np.abs(x))
        for _ in range(2):
            x -= out[:, first:j] @ (out[:, first:j].T @ x)
        out[:, j] = x / np.linalg.norm(x)
    return out


def leading_eigenvectors(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and unit eigenvectors as columns; the largest entry of each is positive."""
    if not k:
        return np.zeros(0), np.zeros((len(matrix), 0))
    size = float(np.max(np.abs(matrix), initial=0.0)) or 1.0
    diagonal, off, reflectors = tridiagonal(matrix / size)
    values = leading_eigenvalues(diagonal, off, k)
    vectors = tridiagonal_vectors(diagonal, off, values)
    for i in reversed(range(len(reflectors))):
        if reflectors[i] is not None:
            v = reflectors[i]
            vectors[i + 1:] -= 2 * np.outer(v, v @ vectors[i + 1:])
    peaks = vectors[np.abs(vectors).argmax(axis=0), np.arange(k)]
    return values * size, vectors * np.sign(peaks)


# --- the operator ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """A fitted transformation: d numbers a component, so it can be sent to every task."""

    n: int  # vectors it was fitted on
    pivot: list[int]  # per dimension, the integer next to the mean
    rest: list[int]  # per dimension, the sum of what the vectors exceed the pivot by
    eigenvalues: np.ndarray
    vectors: np.ndarray  # a column for each component
    total: float  # variance of all dimensions together

    @property
    def explained(self) -> list[float]:
        return [float(e / self.total) for e in self.eigenvalues]

    def deviations(self, z: np.ndarray) -> np.ndarray:
        """``n * x - S``, exactly, from entries centred at the pivot."""
        fits = self.n * max(_most(z), 1) + max(map(abs, self.rest), default=0) < 1 << 62
        return z * self.n - np.array(self.rest, dtype=np.int64) if fits else z.astype(object) * self.n - np.array(self.rest, dtype=object)

    def whitened(self, deviations: np.ndarray) -> np.ndarray:
        return (deviations.astype(np.float64) / self.n) @ (self.vectors / np.sqrt(self.eigenvalues))


def _squares(deviations: np.ndarray) -> pa.Array:
    """Sums of squares by row, exact; null beyond 38 digits."""
    if deviations.dtype != object and max(_most(deviations), 1) ** 2 * deviations.shape[1] < 1 << 63:
        return pa.array((deviations * deviations).sum(axis=1), pa.int64()).cast(DECIMAL)
    wide = (deviations.astype(object) ** 2).sum(axis=1)
    return pa.array([Decimal(int(v)) if v < 10**38 else None for v in wide], DECIMAL)


def _vectors(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).cast("array<double>").alias("v"))


def fit(df: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Whitening of all usable vectors of ``column``, with up to ``components`` components.

    An entry c becomes floor(1024 * c) + 100000. Left out are null vectors, vectors with a null or non-finite entry (one
    beyond 2**40 counts as such) and vectors whose length is not the most frequent one (of equally many, the longer). Two
    passes, both over all rows: the sums, then the products of entries centred at the integer next to the mean. These are
    integers, so the covariance, corrected for the rest of the mean, is exact until it is rounded to doubles once,
    whatever the partitioning. Tasks send partial sums only; the driver holds the d x d matrix.

    Repeated rows count each time. Components without variance are left out, so an empty table, a single vector or
    equal vectors have none; of equal eigenvalues any orthogonal choice is taken, the same in every run.
    """
    vectors = _vectors(df, column)
    n, sums = _dimension_and_sums(vectors)
    d = len(sums)
    pivot = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * p for s, p in zip(sums, pivot)]
    if not n:
        return Whitening(0, [], [], np.zeros(0), np.zeros((0, 0)), 0.0)
    products = _centred_products(vectors, pivot)
    covariance = np.array([[(n * products[i][j] - rest[i] * rest[j]) / (n * n) for j in range(d)] for i in range(d)])
    values, directions = leading_eigenvectors(covariance, min(components, d) if covariance.any() else 0)
    keep = int(np.count_nonzero(values > LEAST_SHARE * max(values[:1], default=0.0)))
    return Whitening(n, pivot, rest, values[:keep], directions[:, :keep], float(np.trace(covariance)))


def whiten(df: DataFrame, model: Whitening, column: str = "embedding", name: str = "whitened") -> DataFrame:
    """The usable rows of ``df`` with their projections, and the exact sum of squares of ``n * x - S``.

    Adds ``<name>`` (array<double>, a number for each component) and ``<name>_deviation`` (decimal, null beyond 38 digits),
    with underscores before a name that is taken; all other columns stay, nulls included. Rows are usable as in ``fit``.
    """
    name, deviation = free_name(df, name), free_name(df, f"{name}_deviation")
    taken = free_name(df, "_vector")
    sent = shipped(df.sparkSession, model)
    work = df.withColumn(taken, F.col(column).cast("array<double>"))
    schema = df.withColumn(name, F.lit(None).cast("array<double>")).withColumn(deviation, F.lit(None).cast("decimal(38,0)")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = opened(sent)
        d, k = model.vectors.shape
        for batch in batches:
            for rows, x in scaled_rows(batch.column(batch.num_columns - 1)):
                if x.shape[1] != d:
                    continue
                off = model.deviations(x - np.array(model.pivot, dtype=np.int64))
                projected = model.whitened(off)
                kept = batch.take(pa.array(rows))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * k, pa.int32()), pa.array(projected.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns[:-1], lists, _squares(off)], names=[*kept.schema.names[:-1], name, deviation])

    return work.mapInArrow(run, schema)


def identity_error(df: DataFrame, model: Whitening, column: str = "embedding") -> float:
    """Largest absolute entry of the projections' covariance minus the identity, measured over all usable rows.

    Tasks send their counts, means and centred products, which Spark adds up: k (k + 3) / 2 numbers a task.
    """
    k = len(model.eigenvalues)
    if not k:
        return 0.0
    sent = shipped(df.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = opened(sent)
        n, mean, within = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for _, x in scaled_rows(batch.column(0)):
                if x.shape[1] == model.vectors.shape[0]:
                    w = model.whitened(model.deviations(x - np.array(model.pivot, dtype=np.int64)))
                    centre = w.mean(axis=0)
                    step = centre - mean
                    within += (w - centre).T @ (w - centre) + np.outer(step, step) * (n * len(w) / (n + len(w)))
                    mean, n = mean + step * (len(w) / (n + len(w))), n + len(w)
        if n:
            rows = [(a, b, within[a, b], n * mean[a] * mean[b]) for a in range(k) for b in range(a, k)] + [(a, -1, 0.0, n * mean[a]) for a in range(k)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], schema=pa.schema(
                [("a", pa.int64()), ("b", pa.int64()), ("within", pa.float64()), ("between", pa.float64())]))

    parts = _vectors(df, column).mapInArrow(run, "a long, b long, within double, between double")
    sums = {(r.a, r.b): (r.w, r.m) for r in parts.groupBy("a", "b").agg(F.sum("within").alias("w"), F.sum("between").alias("m")).collect()}
    mean = [sums[a, -1][1] / model.n for a in range(k)]
    return max(abs(sum(sums[a, b]) / model.n - mean[a] * mean[b] - (a == b)) for a in range(k) for b in range(a, k))
