"""Whitening against a full eigendecomposition of the covariance of exact integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import whitening
from millrace.llm.queries import QUERIES


def brute(vectors, components=8):
    """(n, deviations, projections, explained shares) of usable vectors, in Python integers and numpy's decomposition."""
    x = [[math.floor(1024 * float(c)) + 100000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    off = [[n * c - s for c, s in zip(row, sums)] for row in x]
    deviations = [sum(c * c for c in row) for row in off]
    centred = np.array([[c / n for c in row] for row in off])
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(values)[::-1][:components]
    order = [i for i in order if values[i] > 1e-10 * values.max()]
    return n, deviations, centred @ directions[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def usable(v):
    return v is not None and len(v) == 12 and all(c is not None and abs(c) <= 2**40 for c in v)  # NaN compares false


def vectors(seed=1, n=400, d=12):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((n, d)) @ rng.standard_normal((d, d)) + 3).astype(np.float32).tolist()


def check(spark, rows, schema="vec_id long, embedding array<float>, whitened string, label int", parts=3):
    df = spark.createDataFrame(rows, schema).repartition(parts)
    model = whitening.fit(df)
    n, deviations, projections, explained = brute([r[1] for r in rows if usable(r[1])])
    have = whitening.whiten(df, model).collect()
    assert model.n == n == len(have)
    assert sorted(int(r["_whitened_deviation"] if "_whitened_deviation" in r else r["whitened_deviation"]) for r in have) == sorted(deviations)
    np.testing.assert_allclose(model.explained, explained, rtol=1e-9)
    want = {}
    for r, p in zip([r for r in rows if usable(r[1])], projections):
        want.setdefault((r[0], tuple(r[1])), p)
    signs = None
    for r in have:
        got, p = np.array(r["_whitened"]), want[r["vec_id"], tuple(r["embedding"])]
        if signs is None:
            signs = np.sign(got * p)
        np.testing.assert_allclose(got, p * signs, atol=1e-6)
    assert whitening.identity_error(df, model) < 1e-9
    return model


def test_odd_rows(spark):
    rows = [(i, v, "clash", None) for i, v in enumerate(vectors())]
    bad = [None, [], [1.0] * 11, [None] * 12, [1.0] * 11 + [None], [math.nan] * 12, [math.inf] + [0.0] * 11, [1e30] * 12, [1.0] * 13]
    rows += [(None, rows[0][1], None, 1), (None, None, None, None), *[(7, rows[7][1], "x", 2)] * 200]
    check(spark, rows + [(1000 + i, v, "bad", 1) for i, v in enumerate(bad)])


def test_partitions_do_not_matter(spark):
    rows = [(i, v, "c", 1) for i, v in enumerate(vectors(2))]
    a, b = check(spark, rows, parts=1), check(spark, rows[::-1], parts=7)
    assert np.array_equal(a.vectors, b.vectors) and np.array_equal(a.eigenvalues, b.eigenvalues)


def test_few_rows_and_constant_dimensions(spark):
    few = vectors(3, n=4)
    assert check(spark, [(i, v, "c", 1) for i, v in enumerate(few)]).vectors.shape[1] == 3
    flat = [[v[0]] + [2.5] * 9 + [v[1], v[1]] for v in vectors(4)]
    assert check(spark, [(i, v, "c", 1) for i, v in enumerate(flat)]).vectors.shape[1] == 2


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, None)], [(1, [])]])
def test_nothing_to_whiten(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    model = whitening.fit(df)
    found = whitening.whiten(df, model)
    assert found.columns == ["vec_id", "embedding", "whitened", "whitened_deviation"]
    assert [r.whitened for r in found.collect()] == [[]] * sum(1 for r in rows if r[1])
    assert whitening.identity_error(df, model) == 0.0 and model.explained == []


def test_large_entries_stay_exact():
    z = np.array([[1 << 40, 3], [-(1 << 41), 5], [7, 1 << 50]], dtype=np.int64)
    exact = z.astype(object)
    assert (whitening._products(z) == exact.T @ exact).all()
    model = whitening.Whitening(10**9, [0, 0], [5, -7], np.ones(1), np.ones((2, 1)), 1.0)
    off = model.deviations(z)
    assert (off == exact * 10**9 - np.array([5, -7], dtype=object)).all()
    wide = [sum(int(c) ** 2 for c in row) for row in off]
    assert [None if v is None else int(v) for v in whitening._squares(off).to_pylist()] == [v if v < 10**38 else None for v in wide]


@pytest.mark.parametrize("seed", range(6))
def test_eigenvectors(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 40))
    basis = np.linalg.qr(rng.standard_normal((n, n)))[0]
    spectra = {0: rng.random(n), 1: np.ones(n), 2: np.r_[np.full(n // 2, 5.0), rng.random(n - n // 2)], 3: 10.0 ** -np.arange(n),
               4: np.round(rng.random(n) * 3), 5: 1 + 1e-13 * rng.random(n)}
    a = basis * spectra[seed] @ basis.T
    a = (a + a.T) / 2 * 1e7
    for matrix in (a, np.diag(np.diag(a)), np.kron(np.eye(2), a)):
        k = min(8, len(matrix))
        values, found = whitening.leading_eigenvectors(matrix, k)
        size = np.abs(matrix).max()
        np.testing.assert_allclose(values, np.linalg.eigvalsh(matrix)[::-1][:k], atol=1e-13 * size * len(matrix))
        assert np.abs(found.T @ found - np.eye(k)).max() < 1e-12
        assert np.abs(matrix @ found - found * values).max() < 1e-11 * size


def test_sturm_counts():
    rng = np.random.default_rng(5)
    diagonal, off = rng.standard_normal(30), rng.standard_normal(29)
    values = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1))
    shifts = rng.standard_normal(50) * 3
    assert whitening.count_below(diagonal, off, shifts, 1e-30).tolist() == [int((values < s).sum()) for s in shifts]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = QUERIES["op11_whitening"](spark, sf).toPandas()
    table = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    n, deviations, projections, explained = brute([r.embedding for r in table])
    assert len(rows) == 8 * n and set(rows.n) == {n} and rows.identity_error.max() <= 1e-4 and rows.identity_error.nunique() == 1
    wide = rows.pivot(index="vec_id", columns="component", values="whitened").sort_index()
    assert list(wide.columns) == list(range(1, 9)) and wide.index.tolist() == [r.vec_id for r in table]
    signs = np.sign(wide.to_numpy()[0] * projections[0])
    np.testing.assert_allclose(wide.to_numpy(), projections * signs, atol=1e-8)
    assert rows.drop_duplicates("vec_id").sort_values("vec_id").deviation.tolist() == deviations
    np.testing.assert_allclose(rows.drop_duplicates("component").sort_values("component").explained, explained, rtol=1e-9)
