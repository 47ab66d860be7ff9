"""Whitening against numpy's eigenvectors and exact sums, on given and on degenerate vectors."""

from fractions import Fraction

import numpy as np
import pytest
from conftest import DATA

from groundmill.llm import whitening as w

SCHEMA = "vec_id long, embedding array<double>, n int, whitened string"


def check(vectors, found, components=32):
    """``found`` rows against plain numpy over ``vectors`` ({vec_id: list})."""
    x = np.floor(64 * np.array(list(vectors.values()), np.float64)).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    cov = np.cov(x.T.astype(np.float64), bias=True).reshape(x.shape[1], x.shape[1])
    values, parts = np.linalg.eigh(cov)
    values, parts = values[::-1][:components], parts[:, ::-1][:, :components]
    by_id = {r["vec_id"]: r for r in found}
    assert by_id.keys() == vectors.keys()
    got = np.array([by_id[i]["whitened"] for i in vectors])
    rank = got.shape[1]
    assert rank == min(components, np.linalg.matrix_rank(cov))
    deviation = ((n * x - total).astype(object) ** 2).sum(axis=1)
    assert [int(by_id[i]["deviation"]) for i in vectors] == deviation.tolist()
    assert all(r["n"] == n and r["identity_error"] < 1e-12 for r in found)
    assert np.allclose(found[0]["explained"], values[:rank] / np.trace(cov), rtol=1e-9)
    # Spaces of equal eigenvalues have no fixed basis, so the whitened Gram matrices of each space are compared.
    want = (x - total / n) @ parts[:, :rank] / np.sqrt(values[:rank])
    at = 0
    while at < rank:
        end = at + 1
        while end < rank and values[end] > values[at] * (1 - 1e-9):
            end += 1
        if end < len(values) or rank == x.shape[1] or rank < components:
            assert np.allclose(got[:, at:end] @ got[:, at:end].T, want[:, at:end] @ want[:, at:end].T, atol=1e-6)
        at = end


def test_given_vectors(spark):
    table = spark.read.parquet(f"{DATA}/sf0.001/embeddings.parquet")
    check({r["vec_id"]: r["embedding"] for r in table.collect()}, w.whiten(table).collect())


@pytest.mark.parametrize(
    "rows",
    [
        [[s if j == i else 0.0 for j in range(5)] for i in range(5) for s in (1.0, -1.0)],  # one eigenvalue five times
        [[float(i), 2.0 * i, 0.5, float(i * i % 7)] for i in range(20)],  # rank 2 of 4, a constant dimension
        [[float(i % 3), float(i // 3), float(i % 3) * (i // 3)] for i in range(9)],
        [[1e5 * ((i * 37) % 11 - 5), -3.0 * ((i * 17) % 13)] for i in range(30)],
    ],
)
def test_degenerate_vectors(spark, rows):
    table = spark.createDataFrame([(i, r, 1, "clash") for i, r in enumerate(rows)], SCHEMA)
    check(dict(enumerate(rows)), w.whiten(table).collect())


def test_awkward_rows(spark, tmp_path):
    inf = float("inf")
    rows = [(1, [1.0, 2.0]), (2, [3.0, 1.0]), (2, [3.0, 1.0]), (3, None), (4, [None, 1.0]), (5, [inf, 1.0]), (6, [float("nan"), 0.0]), (None, [0.0, 0.0]), (7, [2.0]), (8, [])]
    found = w.whiten(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0) for r in found) == [(False, 1), (False, 2), (False, 2), (False, 7), (False, 8), (True, 0)]
    assert all(r["n"] == 6 and len(r["whitened"]) == 2 for r in found)
    assert w.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    same = w.whiten(spark.createDataFrame([(i, [1.0, 2.0], 1, "x") for i in range(3)], SCHEMA)).collect()
    assert [(r["whitened"], int(r["deviation"])) for r in same] == [([], 0)] * 3
    huge = w.whiten(spark.createDataFrame([(1, [1e200, 1.0], 1, "x"), (2, [-1e200, 2.0], 1, "x"), (3, [0.0, 5.0], 1, "x")], SCHEMA)).collect()
    assert len(huge) == 3 and huge[0]["identity_error"] < 1e-12
    spark.createDataFrame([(i, [1e200 * i], 1, "x") for i in range(3)], SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert {r["deviation"] for r in w.op11_whitening(spark, str(tmp_path)).collect()} == {None}


def test_polynomial_is_exact(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(-50, 50, (12, 6))
    m = (x.T @ x).tolist()
    poly = w.characteristic_polynomial(spark, m)

    def det(a):
        a, d = [[Fraction(v) for v in row] for row in a], Fraction(1)
        for c in range(len(a)):
            p = next((r for r in range(c, len(a)) if a[r][c]), None)
            if p is None:
                return 0
            if p != c:
                a[c], a[p], d = a[p], a[c], -d
            d *= a[c][c]
            for r in range(c + 1, len(a)):
                f = a[r][c] / a[c][c]
                a[r] = [u - f * v for u, v in zip(a[r], a[c], strict=True)]
        return d

    for at in range(7):
        assert sum(c * at**i for i, c in enumerate(poly)) == det([[(at if i == j else 0) - m[i][j] for j in range(6)] for i in range(6)])
    values = np.linalg.eigvalsh(np.array(m, float))[::-1]
    for k in range(6):
        root = w.isolate_root(poly, k + 1)
        assert (root.first, root.last) == (k + 1, k + 1) and abs(float(root.value) / values[k] - 1) < 1e-9
        assert w.roots_above(poly, root.low, root.bits) == k + 1 and w.roots_above(poly, root.low + 1, root.bits) == k


def test_scatter_of_wide_numbers_is_exact():
    x = np.random.default_rng(2).integers(-(1 << 61), 1 << 61, (3000, 3))
    assert (w.exact_scatter(x) == x.T.astype(object) @ x.astype(object)).all()
