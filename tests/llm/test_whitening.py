import math

import numpy as np
import pytest
from tables import TINY

from tidemark.llm import base, whitening as q


@pytest.mark.parametrize("values", [
    [5, 4, 3, 2, 1], [3, 3, 3, 1, 1, 0.5], [1, 1, 1, 1], [7, 1e-9, 1e-9], [2], [9, 4], [1 + 1e-12, 1, 1 - 1e-12, 0.2],
    list(np.linspace(1, 60, 60))])
def test_eigenvectors(values):
    rng = np.random.default_rng(len(values))
    o = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0]
    v = o @ np.diag(values) @ o.T
    v = (v + v.T) / 2
    e, x = q.leading_components(v, len(values))
    assert np.allclose(e, np.linalg.eigvalsh(v)[::-1], rtol=0, atol=1e-12 * max(values))
    assert np.abs(x.T @ x - np.eye(len(e))).max() < 1e-12
    assert np.abs(v @ x - x * e).max() < 1e-12 * max(values)


def test_singular_and_tridiagonal_matrices():
    assert len(q.leading_components(np.zeros((3, 3)), 3)[0]) == 0
    e, x = q.leading_components(np.diag([0.0, 2.0, 0.0, 2.0]), 4)
    assert np.allclose(e, [2, 2]) and np.abs(x.T @ x - np.eye(2)).max() < 1e-14
    a = np.random.default_rng(1).normal(size=(9, 9))
    d, off, o = q.tridiagonal(a @ a.T)
    t = np.diag(d) + np.diag(off, 1) + np.diag(off, -1)
    assert np.abs(o @ t @ o.T - a @ a.T).max() < 1e-12
    at = np.array([0.0, 1.0, 5.0, 100.0])
    assert q.sturm_counts(d, off, at).tolist() == [(np.linalg.eigvalsh(t) < p).sum() for p in at]


def brute(rows, k=32):
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for _, v in rows])
    n, s = len(x), x.sum(axis=0)
    y = x - s / n
    cov = y.T @ y / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    deviation = [sum(int(n * a - b) ** 2 for a, b in zip(r, s)) for r in x]
    return n, deviation, y @ u / np.sqrt(e), e / np.trace(cov)


def test_whole_table_equals_brute_force(spark):
    table = base.table(spark, TINY, "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    n, deviation, white, explained = brute(rows)
    got = q.whiten(table).collect()
    assert len(got) == 32 * n and {r["n"] for r in got} == {n}
    at = {i: j for j, (i, _) in enumerate(rows)}
    out = np.zeros(white.shape)
    for r in got:
        j, c = at[r["vec_id"]], r["component"] - 1
        out[j, c] = r["whitened"]
        assert r["deviation"] == deviation[j] and abs(r["explained"] / explained[c] - 1) < 1e-9
        assert r["identity_error"] < 1e-9
    sign = np.sign((out * white).sum(axis=0))
    assert np.abs(out * sign - white).max() < 1e-6


def test_edges(spark):
    schema = "vec_id bigint, embedding array<float>, label int, n int, v int"
    make = lambda rows: spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], schema)
    good = [(1, [0.0, 1.0]), (2, [1.0, 0.5]), (2, [1.0, 0.5]), (None, [-1.0, 2.0]), (5, [0.25, -1.0])]
    bad = [(6, None), (7, []), (8, [None, 1.0]), (9, [math.nan, 1.0]), (10, [math.inf, 0.0]), (11, [1.0]), (12, [1e30, 0.0])]
    out = q.whiten(make(good + bad)).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in out) == sorted((i or 0, c) for i, _ in good for c in (1, 2))
    n, deviation, white, _ = brute(good)
    assert sorted(r["deviation"] for r in out if r["component"] == 1) == sorted(deviation)
    assert np.allclose(sorted(abs(r["whitened"]) for r in out), sorted(np.abs(white).ravel()))
    assert q.whiten(make([])).count() == 0 and q.whiten(make(bad[:5])).count() == 0
    assert q.whiten(make([(1, [1.0, 2.0])] * 3)).count() == 0  # no variance, no component
    line = q.whiten(make([(i, [float(i), 2.0 * i]) for i in range(5)])).collect()
    assert {r["component"] for r in line} == {1} and abs(line[0]["explained"] - 1) < 1e-12


def test_deviations_beyond_long_are_null():
    x = np.array([[1 << 40, 0], [0, 0]])
    assert q._deviations(x, 2, [1 << 40, 0]) == [None, None]
    x = np.array([[1 << 30, 0], [0, 0]])
    assert q._deviations(x, 2, [1 << 30, 0]) == [1 << 60, 1 << 60]
