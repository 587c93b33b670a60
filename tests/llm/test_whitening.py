"""Jacobi-Davidson whitening against a dense eigendecomposition."""

import numpy as np
import pytest

from trafficlens.llm import queries as Q
from trafficlens.llm import whitening as W


def dense(vectors):
    x = np.floor(np.array(vectors, float) * 1024).astype(int) + 100_000
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    cov = centred.T @ centred / n
    values, u = np.linalg.eigh(cov)
    dev = [sum((n * int(v) - int(t)) ** 2 for v, t in zip(row, s)) for row in x]
    return n, dev, centred, np.trace(cov), values[::-1], u[:, ::-1]


def check(rows, ids, vectors, k):
    n, dev, centred, trace, values, u = dense(vectors)
    assert len(rows) == n * k
    got = {}
    for r in rows:
        got.setdefault(r.component, {}).setdefault(r.vec_id, []).append(r)
    for c in range(1, k + 1):
        w = centred @ u[:, c - 1] / np.sqrt(values[c - 1])
        first = got[c][ids[int(np.argmax(np.abs(w)))]][0]
        w *= np.sign(first.whitened) * np.sign(w[int(np.argmax(np.abs(w)))])
        for i, v in enumerate(ids):
            r = got[c][v].pop() if len(got[c][v]) > 1 else got[c][v][0]
            assert r.n == n and r.deviation == dev[i] and abs(r.whitened - w[i]) < 1e-8
            assert abs(r.explained - values[c - 1] / trace) < 1e-12 and r.identity_error < 1e-10


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_table(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = Q.op13_whitening(spark, path).collect()
    table = spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding").collect()
    check(rows, [r.vec_id for r in table], [r.embedding for r in table], 8)


def test_defined_cases(spark):
    rng = np.random.default_rng(3)
    good = [(i, [float(v) for v in rng.standard_normal(5).astype(np.float32) * (1, 2, 3, 4, 5)]) for i in range(40)]
    good += [(7, good[7][1]), (None, [0.0] * 5)]
    bad = [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [float("nan")] + [0.0] * 4), (103, [float("-inf")] + [0.0] * 4),
           (104, [1.0, 2.0]), (105, [])]
    df = spark.createDataFrame(good + bad, "vec_id bigint, embedding array<float>").selectExpr("*", "1 as n", "'x' as component")
    rows = W.whiten(df, k=8).collect()
    check(rows, [i for i, _ in good], [v for _, v in good], 5)
    assert W.whiten(df.limit(0)).count() == 0
    same = spark.createDataFrame([(1, [1.0, 2.0])] * 3, "vec_id bigint, embedding array<double>")
    assert W.whiten(same).count() == 0  # no variance, no component
    flat = spark.createDataFrame([(i, [float(i), 0.0, float(i)]) for i in range(9)], "vec_id bigint, embedding array<double>")
    assert {r.component for r in W.whiten(flat).collect()} == {1}


def test_large_entries(spark):
    """Exact sums beyond 64 bits: the deviation is null where it is no long."""
    df = spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 2.0])], "vec_id bigint, embedding array<double>")
    rows = W.whiten(df).collect()
    assert {r.deviation for r in rows} == {None, 9 * 0 + (3 * 2048 - 3072) ** 2} and all(abs(r.whitened) < 2 for r in rows)


@pytest.mark.parametrize("dim,k", [(3, 8), (40, 8), (200, 3)])
def test_solver(dim, k):
    rng = np.random.default_rng(dim)
    m = rng.standard_normal((3 * dim, dim))
    m = m.T @ m / len(m)
    got = W.jacobi_davidson(lambda p: m @ p, dim, k, basis=4)
    values = np.linalg.eigvalsh(m)[::-1][:k]
    assert np.allclose(got.values, values, rtol=1e-13) and got.residuals.max() < 1e-13 * values[0] * 10
    assert np.allclose(got.vectors.T @ got.vectors, np.eye(len(values)), atol=1e-13)


def test_minres():
    rng = np.random.default_rng(0)
    m = rng.standard_normal((30, 30))
    m = m + m.T
    b = np.hstack([rng.standard_normal((30, 2)), np.zeros((30, 1))])
    assert np.allclose(m @ W.minres(lambda p: m @ p, b, 200, 1e-13), b, atol=1e-8)
