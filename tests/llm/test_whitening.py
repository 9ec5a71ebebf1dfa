"""Whitening against a dense eigensolver."""

from __future__ import annotations

import math

import numpy as np
import pytest

from riskflow.llm import queries
from riskflow.llm import whitening as wh
from tests.conftest import SF01


def _dense(vectors):
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], dtype=object)
    n, s = len(x), x.sum(axis=0)
    centred = np.array([[float(n * a - t) / n for a, t in zip(row, s)] for row in x])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    return n, [int(sum((n * a - t) ** 2 for a, t in zip(row, s))) for row in x], centred, values[::-1], axes[:, ::-1]


def _check(got, ids, vectors, components=32):
    n, deviation, centred, values, axes = _dense(vectors)
    k = min(components, int((values > 1e-12 * values.sum()).sum()))
    assert len(got) == n * k
    w = np.full((n, k), np.nan)
    at = {i: j for j, i in enumerate(ids)}
    for r in got:
        j, c = at[r["vec_id"]], r["component"] - 1
        w[j, c] = r["whitened"]
        assert (r["n"], r["deviation"]) == (n, deviation[j]) and r["identity_error"] < 1e-9
        assert abs(r["explained"] / (values[c] / values.sum()) - 1) < 1e-10
    gaps = np.abs(values[:k, None] - values[None, :]) + np.where(np.eye(k, len(values)) > 0, np.inf, 0)
    for c in range(k):
        if gaps[c].min() > 1e-3 * values[0]:
            want = centred @ axes[:, c] / np.sqrt(values[c])
            sign = np.sign(want @ w[:, c])
            assert np.abs(sign * w[:, c] - want).max() < 1e-8
    assert np.abs(w.T @ w / n - np.eye(k)).max() < 1e-9


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, n int, x string")


@pytest.mark.parametrize("n, dims", [(300, 5), (500, 64), (40, 64)])
def test_equal_to_a_dense_solver(spark, n, dims):
    draw = np.random.default_rng(n)
    v = (draw.normal(size=(n, dims)) * np.geomspace(3, 0.05, dims)).astype(np.float32)
    got = wh.whiten(_frame(spark, [(i, x.tolist()) for i, x in enumerate(v)]).repartition(3)).collect()
    _check(got, list(range(n)), v)


def test_rows_that_do_not_count(spark):
    rows = [(1, [0.5, 1.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("-inf"), 1.0]), (6, []), (7, [1.0]), (8, [-0.25, 2.0]), (9, [1.5, 1.0]), (9, [1.5, 1.0])]
    got = wh.whiten(_frame(spark, rows)).collect()
    assert sorted(r["vec_id"] for r in got) == [1, 1, 8, 8, 9, 9, 9, 9]
    _check([r for r in wh.whiten(_frame(spark, rows[:-1])).collect()], [1, 8, 9], [r[1] for r in rows if r[0] in (1, 8, 9)][:3])
    out = wh.whiten(_frame(spark, [])).columns
    assert out == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for few in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0]), (None, [1.0])]):
        assert wh.whiten(_frame(spark, few)).count() == 0
    assert {r["vec_id"] for r in wh.whiten(_frame(spark, [(None, [1.0]), (3, [2.0])])).collect()} == {None, 3}


def test_iterations_of_many_dimensions():
    """More dimensions than the subspace holds: corrections, restarts and locking, with close and equal values."""
    draw = np.random.default_rng(5)
    values = np.concatenate([[9.0, 9.0, 8.999, 5.0, 5.0], np.geomspace(4, 1e-6, 495)])
    axes = np.linalg.qr(draw.normal(size=(500, 500)))[0]
    a = (axes * values) @ axes.T
    a, calls = (a + a.T) / 2, []

    def product(x):
        calls.append(x.shape[1])
        return a @ x

    got, vectors, residuals = wh.jacobi_davidson(product, 500, 32)
    assert np.abs(got - values[:32]).max() < 1e-12
    assert np.linalg.norm(a @ vectors - vectors * got, axis=0).max() < 1e-12
    assert np.abs(vectors.T @ vectors - np.eye(32)).max() < 1e-12
    assert residuals.max() < 1e-12 and len(calls) < 150


def test_the_table(spark):
    got = queries.queries()["op13_whitening"](spark, SF01).collect()
    rows = spark.read.parquet(f"{SF01}/embeddings.parquet").collect()
    _check(got, [r["vec_id"] for r in rows], [r["embedding"] for r in rows])
