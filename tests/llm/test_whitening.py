"""Whitening against a full eigendecomposition."""

import math

import numpy as np
import pytest
from conftest import DATA

from ledgerloom.llm import registry, whitening


def check(spark, vectors, count=8, ids=None):
    """Rows of (id, vector) through the operator and through numpy; returns the fit."""
    ids = ids or range(len(vectors))
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in zip(ids, vectors, strict=True)], "vec_id long, v array<double>, x int, row string")
    rows = whitening.whole_vectors(df.repartition(5), "v")
    w = whitening.fit(rows, count)
    dim = max((len(v) for v in vectors if v is not None), default=0)
    good = [(i, v) for i, v in zip(ids, vectors, strict=True) if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in good]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    assert (w.n, w.sums) == (n, sums)
    z = np.array([[(n * c - s) / n for c, s in zip(r, sums, strict=True)] for r in x])
    values, basis = np.linalg.eigh(z.T @ z / n)
    values, basis = values[::-1], basis[:, ::-1]
    k = min(count, int((values > 1e-12 * values.sum()).sum()))
    assert np.allclose(w.variances, values[:k], rtol=1e-10) and np.allclose(w.explained, values[:k] / values.sum(), rtol=1e-9)
    for j in range(k):  # the projection on each space of close values is the same
        near = np.abs(values - values[j]) < 1e-4 * values[0]
        if np.flatnonzero(near).max() < k:
            part = np.abs(w.variances - values[j]) < 1e-4 * values[0]
            assert np.allclose(w.components[:, part] @ w.components[:, part].T, basis[:, near] @ basis[:, near].T, atol=1e-8)
    got = whitening.whiten(rows, w).collect()
    exact = sorted(((i is None, i or 0), sum((n * c - s) ** 2 for c, s in zip(r, sums, strict=True))) for (i, _), r in zip(good, x, strict=True))
    assert sorted(((r["row"]["vec_id"] is None, r["row"]["vec_id"] or 0), r["deviation"]) for r in got) == exact
    white = np.array([r["whitened"] for r in got])
    assert np.allclose(np.cov(white.T, bias=True), np.eye(k), atol=1e-9) and whitening.identity_error(rows, w) < 1e-9
    return w


def test_op12_against_eigh(spark):
    r = np.random.default_rng(3)
    vectors = (r.standard_normal((400, 20)) * np.linspace(3, 0.5, 20) + 7).tolist()
    vectors += [None, [None] * 20, [1.0] * 19, [], [float("nan")] + [0.0] * 19, [float("inf")] * 20, vectors[0], vectors[0]]
    check(spark, vectors, ids=[*range(400), None, 1, 2, 3, 4, 5, None, 7])


def test_op12_wide_close_and_flat(spark):
    r = np.random.default_rng(4)
    w = check(spark, (r.standard_normal((300, 150)) * 5).tolist())  # more dimensions than the basis holds, close values
    assert len(w.variances) == 8
    assert len(check(spark, (r.standard_normal((50, 3)) @ r.standard_normal((3, 30)) * 400).tolist(), count=2).variances) == 2
    assert len(check(spark, [[0.0, 1.0, 2.0], [1.0, 1.0, 2.0], [0.5, 1.0, 2.0]]).variances) == 1  # flat dimensions


def test_op12_without_variance(spark):
    schema = "vec_id long, v array<float>"
    for rows in ([], [(1, None)], [(1, [])], [(1, [0.5, 0.5]), (2, [0.5, 0.5])]):
        assert not len(whitening.fit(whitening.whole_vectors(spark.createDataFrame(rows, schema), "v"), 8).variances)
    large = whitening.whole_vectors(spark.createDataFrame([(1, [3e38, 1.0]), (2, [-3e38, 1.0])], schema), "v")
    assert [r["deviation"] for r in whitening.whiten(large, whitening.fit(large, 8)).collect()] == [None, None]


def test_op12_query(spark):
    out = registry.queries()["op12_whitening"](spark, DATA)
    n = spark.read.parquet(f"{DATA}/embeddings.parquet").count()
    rows = out.collect()
    assert len(rows) == 8 * n and {r["component"] for r in rows} == set(range(1, 9))
    assert max(r["identity_error"] for r in rows) == pytest.approx(0, abs=1e-9)
