import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from runlens.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int"


def svd_check(x):
    """The solver on the triangle of x against numpy's SVD."""
    x = x - x.mean(axis=0)
    r = np.linalg.qr(x, mode="r")
    values, v = W.components(np.vstack([r, np.zeros((x.shape[1] - len(r), x.shape[1]))]))
    want = np.linalg.svd(x, compute_uv=False) ** 2
    assert np.allclose(values, want[:len(values)], rtol=1e-12)
    assert np.abs(v.T @ v - np.eye(len(values))).max(initial=0) < 1e-11
    assert np.abs(x.T @ (x @ v) - v * values).max(initial=0) <= 1e-13 * max(want[0], 1e-300)
    return len(values)


def test_solver_on_matrices_of_many_kinds():
    rng = np.random.default_rng(1)
    assert svd_check(rng.normal(size=(300, 40))) == 8
    assert svd_check(rng.normal(size=(300, 40)) @ np.diag(10.0 ** -np.arange(40))) == 8          # graded
    assert svd_check(np.vstack([np.eye(20), -np.eye(20)])) == 8                                   # all equal
    assert svd_check(np.vstack([np.eye(20), -np.eye(20)]) + 1e-13 * rng.normal(size=(40, 20))) == 8
    assert svd_check(np.repeat(rng.normal(size=(90, 3)), 5, axis=1)) == 3                          # of rank three
    assert svd_check(np.hstack([rng.normal(size=(90, 4)), np.zeros((90, 4))])) == 4
    assert svd_check(rng.normal(size=(3, 30))) == 2 and svd_check(rng.normal(size=(30, 1))) == 1
    assert svd_check(np.zeros((5, 4))) == 0
    assert svd_check(rng.integers(0, 2, size=(60, 9)).astype(float)) == 8


def test_bidiagonal_form_and_small_values():
    rng = np.random.default_rng(2)
    r = np.triu(rng.normal(size=(12, 12)))
    a, b, v = W.bidiagonalise(r)
    m = np.diag(a) + np.diag(b, 1)
    assert np.allclose(v.T @ v, np.eye(12)) and np.allclose(v @ (m.T @ m) @ v.T, r.T @ r)
    # two singular values of [[1, h], [0, t]]: their product is t; the small one is t^2 / large one, far below rounding of the sum
    t = 1e-150
    large, small = W.squared_singular_values(np.array([1.0, t]), np.array([1.0]))
    assert math.isclose(small, t * t / large, rel_tol=1e-14) and math.isclose(large, 2.0, rel_tol=1e-14)


def brute(rows, top=8):
    good = [(i, [math.floor(1024 * float(c)) + 100000 for c in v]) for i, v in rows]
    x = np.array([v for _, v in good], dtype=float)
    n, sums = len(good), [sum(v[d] for _, v in good) for d in range(x.shape[1])]
    c = x - x.mean(axis=0)
    e, v = np.linalg.eigh(c.T @ c / n)
    order = np.argsort(e)[::-1][:top]
    return n, sums, good, c, e[order], v[:, order], e.sum()


def check(got, rows, top):
    n, sums, good, c, e, v, trace = brute(rows, top)
    by = {(r["vec_id"], r["component"]): r for r in got}
    assert len(got) == len(rows) * top and {r["n"] for r in got} == {n} and max(r["identity_error"] for r in got) < 1e-9
    for (i, x), own in zip(good, c):
        want = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        for k in range(top):
            assert int(by[i, k + 1]["deviation"]) == want
            assert math.isclose(by[i, k + 1]["explained"], e[k] / trace, rel_tol=1e-9)
    for k in range(top):
        mine = np.array([by[i, k + 1]["whitened"] for i, _ in rows])
        theirs = c @ v[:, k] / math.sqrt(e[k])
        assert min(np.abs(mine - theirs).max(), np.abs(mine + theirs).max()) < 1e-7


def test_against_eigenvectors_with_unusable_rows(spark, monkeypatch):
    monkeypatch.setattr(W, "BLOCK", 16)
    monkeypatch.setattr(W, "FAN_IN", 2)
    rng = np.random.default_rng(6)
    rows = [(i, [float(np.float32(v)) for v in rng.normal(size=10) * np.arange(1, 11)]) for i in range(200)]
    rows += [(500, rows[0][1])]
    bad = [(900, None), (901, [1.0] * 9 + [None]), (902, [math.nan] * 10), (903, [math.inf] + [0.0] * 9), (904, []), (905, [1.0, 2.0]),
           (None, None), (906, [3e38] * 10)]
    table = spark.createDataFrame([(i, v, None) for i, v in rows + bad], SCHEMA).repartition(7)
    for name in ("n", "x", "component", "whitened", "z", "slot", "r"):
        table = table.withColumn(name, F.lit("x"))
    check(W.whiten(table).collect(), rows, 8)


def test_few_dimensions_null_ids_and_repeats(spark):
    rows = [(i, [float(i % 7), float(i * i % 5)]) for i in range(40)]
    check(W.whiten(spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)).collect(), rows, 2)
    twice = spark.createDataFrame([(None, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (4, [2.0, 2.0], 1)], SCHEMA)
    got = W.whiten(twice).collect()
    assert len(got) == 3 and {r["component"] for r in got} == {1}                  # one direction varies


def test_large_numbers_stay_exact(spark):
    rows = [(i, [float(2 ** 39 + i * 1024), float(i % 3)]) for i in range(30)]
    got = W.whiten(spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, label int")).collect()
    _, sums, good, *_ = brute(rows)
    want = {i: sum((30 * a - s) ** 2 for a, s in zip(x, sums)) for i, x in good}
    assert all(int(r["deviation"]) == want[r["vec_id"]] for r in got)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], 1)], [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)], [(1, None, 1)]])
def test_nothing_that_varies(spark, rows):
    got = W.whiten(spark.createDataFrame(rows, SCHEMA))
    assert got.collect() == [] and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
