import math
from decimal import Decimal

import numpy as np
import pytest

from quarterdeck.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n string, component string"


def frame(spark, vectors, ids=None):
    rows = [(k if ids is None else ids[k], v, None, "own", "own") for k, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def plain(vectors, components=8):
    """Exact sums in Python integers, numpy's eigenvectors."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(row[j] for row in x) for j in range(d)]
    t = [[n * row[j] - s[j] for j in range(d)] for row in x]
    v = np.array([[sum(r[i] * r[j] for r in t) / n**3 for j in range(d)] for i in range(d)])
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:components], axes.T[::-1][:components]
    white = np.array([[r / n for r in row] for row in t]) @ (axes / np.sqrt(values)[:, None]).T
    return n, [sum(c * c for c in row) for row in t], white, values / np.trace(v)


def test_matches_numpy(spark):
    random = np.random.default_rng(3)
    vectors = (random.standard_normal((300, 12)) * np.linspace(0.05, 0.4, 12)).astype(np.float32).tolist()
    n, deviations, white, shares = plain(vectors)
    got = {(r["vec_id"], r["component"]): r for r in whitening.whiten_embeddings(frame(spark, vectors)).collect()}
    assert set(got) == {(i, c) for i in range(300) for c in range(1, 9)}
    table = np.array([[got[i, c]["whitened"] for c in range(1, 9)] for i in range(300)])
    signs = np.sign((table * white).sum(axis=0))
    assert np.allclose(table, white * signs, atol=1e-9)
    assert {r["n"] for r in got.values()} == {n}
    assert all(r["deviation"] == deviations[i] for (i, _), r in got.items())
    assert np.allclose([got[0, c]["explained"] for c in range(1, 9)], shares, rtol=1e-12)
    assert max(r["identity_error"] for r in got.values()) < 1e-9


def test_dropped_and_kept_rows(spark):
    random = np.random.default_rng(4)
    good = random.standard_normal((40, 3)).astype(np.float32).tolist()
    nan, inf = float("nan"), float("inf")
    bad = [None, [1.0, None, 2.0], [1.0, nan, 2.0], [1.0, -inf, 2.0], [3e30, 0.0, 0.0], [], [1.0, 2.0]]
    vectors = good + good[:5] + bad
    ids = [None if k % 7 == 0 else k for k in range(45)] + list(range(100, 107))
    got = whitening.whiten(frame(spark, vectors, ids)).collect()
    assert len(got) == 45 * 3 and {r["n"] for r in got} == {45}
    assert sum(r["vec_id"] is None for r in got) == 7 * 3
    assert not {r["vec_id"] for r in got} & set(range(100, 107))


def test_without_variance(spark):
    same = whitening.whiten(frame(spark, [[0.5, 0.25]] * 9)).collect()
    assert len(same) == 18 and all(r["whitened"] is None and r["explained"] is None and r["identity_error"] is None for r in same)
    assert all(r["deviation"] == 0 for r in same)
    line = whitening.whiten(frame(spark, [[0.5, k / 1024] for k in range(10)])).collect()
    assert {r["component"]: r["explained"] for r in line} == {1: 1.0, 2: 0.0}
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in line)


def test_empty_table(spark):
    for vectors in ([], [None], [[]]):
        got = whitening.whiten_embeddings(frame(spark, vectors))
        assert got.count() == 0
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviations_beyond_a_long(spark):
    vectors = [[2.0**29, 0.0], [-(2.0**29), 1.0], [2.0**29, 2.0], [0.0, 3.0]] * 3
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(frame(spark, vectors)).collect()}
    _, want, _, _ = plain(vectors, 2)
    assert got == {k: Decimal(v) for k, v in enumerate(want)}
    narrow = {r["vec_id"]: r["deviation"] for r in whitening.whiten_embeddings(frame(spark, vectors)).collect()}
    assert narrow == {k: v if v < 2**63 else None for k, v in enumerate(want)} and None in narrow.values()


@pytest.mark.parametrize("size", [1, 2, 5, 17, 40])
def test_inertia_and_eigenpairs(size):
    random = np.random.default_rng(size)
    for spectrum in (random.random(size), np.repeat(random.random(-(-size // 3)), 3)[:size], 10.0 ** -np.arange(size, dtype=float) / 7):
        q, _ = np.linalg.qr(random.standard_normal((size, size)))
        matrix = q @ np.diag(spectrum) @ q.T
        matrix = (matrix + matrix.T) / 2
        for shift in (-0.1, 0.013, 0.3, 0.5, 0.77, 2.0):
            if np.abs(spectrum - shift).min() > 1e-9:
                assert whitening.eigenvalues_above(matrix, shift) == int((spectrum > shift).sum())
        count = min(size, 8)
        values, vectors = whitening.leading_eigenpairs(matrix, count)
        assert np.allclose(values, np.sort(spectrum)[::-1][:count], atol=1e-13)
        assert np.allclose(vectors @ vectors.T, np.eye(count), atol=1e-12)
        assert np.allclose(matrix @ vectors.T, vectors.T * values, atol=1e-13)


def test_exact_products():
    random = np.random.default_rng(1)
    for most in (3, 300, 2**20, 2**27, 2**41):
        y = random.integers(-most, most, (50, 4))
        want = y.astype(object).T @ y.astype(object)
        assert (whitening.exact_products(y) == want).all()
    t = random.integers(-(2**45), 2**45, (20, 6))
    assert whitening.squared_norms(t) == [sum(int(c) ** 2 for c in row) for row in t]
