"""Whitening: the solver against library singular values, the tables against a covariance by definition."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import whitening as w


def square(a):
    r = np.linalg.qr(a, mode="r")
    return np.vstack([r, np.zeros((a.shape[1] - len(r), a.shape[1]))])


RNG = np.random.default_rng(0)
TURN = np.linalg.qr(RNG.normal(size=(50, 50)))[0]
MATRICES = {
    "random": RNG.normal(size=(500, 32)),
    "graded": RNG.normal(size=(500, 32)) * np.logspace(0, -12, 32),
    "few rows": RNG.normal(size=(3, 8)),
    "rank one": np.ones((5, 6)),
    "identity": np.eye(8),
    "equal in pieces": np.kron(np.eye(4), RNG.normal(size=(5, 3))),
    "equal on a diagonal": np.diag([3.0, 3, 3, 3, 1, 1]),
    "one column": RNG.normal(size=(40, 1)),
    "two columns": RNG.normal(size=(40, 2)),
    "close": np.diag(np.r_[5, 5 + 1e-13, 5 - 1e-12, 4.999999, np.linspace(1, 2, 46)]) @ TURN.T,
    "integers": RNG.integers(-90, 90, size=(400, 96)).astype(float),
}


@pytest.mark.parametrize("name", sorted(MATRICES))
def test_solver(name):
    a = MATRICES[name]
    r = square(a)
    diagonal, superdiagonal, v = w.bidiagonalised(r)
    b = np.diag(diagonal) + np.diag(superdiagonal, 1)
    assert np.allclose(v.T @ (r.T @ r) @ v, b.T @ b, atol=1e-10 * np.abs(r.T @ r).max())
    want = np.zeros(a.shape[1])
    want[: min(a.shape)] = np.linalg.svd(a, compute_uv=False)
    got = np.sqrt(w.squared_singular_values(diagonal, superdiagonal))
    assert np.abs(got - want).max() < 1e-13 * want[0]
    values, directions, total = w.principal_directions(r, min(4, a.shape[1]))
    assert np.abs(a.T @ a @ directions - directions * values).max() < 1e-12 * values[0]
    assert np.abs(directions.T @ directions - np.eye(len(values))).max() < 1e-12
    assert math.isclose(total, (a * a).sum(), rel_tol=1e-12)


def test_small_singular_values_are_relatively_accurate():
    """A graded bidiagonal matrix, whose small values a plain eigenvalue solver of the product would lose."""
    diagonal, superdiagonal = 10.0 ** -np.arange(0, 12, 1.0), 10.0 ** -np.arange(0.5, 11, 1.0)
    got = w.squared_singular_values(diagonal, superdiagonal)
    # The product of all values is the product of the diagonal, whatever rounds.
    assert math.isclose(np.log(got).sum(), 2 * np.log(diagonal).sum(), rel_tol=1e-13)


def test_zero_matrix():
    values, directions, total = w.principal_directions(np.zeros((6, 6)), 4)
    assert not values.any() and total == 0 and np.array_equal(directions.T @ directions, np.eye(4))


SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, components=4):
    """(dimension-wise integers per kept row, n, deviation, whitened, explained) by definition."""
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v, _ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    length = max({len(x) for _, x in kept if x}, key=lambda k: (sum(len(x) == k for _, x in kept), -k))
    kept = [(i, x) for i, x in kept if len(x) == length]
    fit = np.array(sorted({tuple(x) for _, x in kept}), dtype=float)
    n, sums = len(fit), fit.sum(axis=0)
    cov = (fit - sums / n).T @ (fit - sums / n) / n
    e, vectors = np.linalg.eigh(cov)
    e, vectors = e[::-1][:components], vectors[:, ::-1][:, :components]
    found = {}
    for i, x in kept:
        for k in range(len(e)):
            value = (np.array(x) - sums / n) @ vectors[:, k] / math.sqrt(e[k])
            found.setdefault((i, k + 1), []).append((n, int(sum((n * a - int(s)) ** 2 for a, s in zip(x, sums))), abs(value), e[k] / np.trace(cov)))
    return found


def compared(spark, rows, parts=5):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    model = w.fit(df)
    got = {}
    for r in w.whiten(df, model).collect():
        got.setdefault((r["vec_id"], r["component"]), []).append((r["n"], r["deviation"], abs(r["whitened"]), r["explained"]))
        assert r["identity_error"] < 1e-10
    want = brute(rows)
    assert set(got) == set(want)
    for key in want:
        for a, b in zip(sorted(got[key]), sorted(want[key]), strict=True):
            assert a[:2] == b[:2]
            assert math.isclose(a[2], b[2], rel_tol=1e-8, abs_tol=1e-8) and math.isclose(a[3], b[3], rel_tol=1e-9)
    return df, model


def test_whitening_by_definition(spark):
    rng = np.random.default_rng(1)
    mix = rng.normal(size=(12, 12)) * np.linspace(3, 0.2, 12)
    rows = [(i, [float(c) for c in rng.normal(size=12) @ mix], 0) for i in range(700)]
    rows += [(1000 + i, rows[3][1], 0) for i in range(300)]  # a third are copies of one
    rows += [(2000, None, 0), (2001, [None] * 12, 0), (2002, [float("nan")] + [0.0] * 11, 0), (2003, [float("inf")] + [0.0] * 11, 0)]
    rows += [(2004, [1.0, 2.0], 0), (2005, [], 0), (5, rows[5][1], 1), (None, rows[6][1], 1)]
    compared(spark, rows)


def test_factors_are_reduced_in_several_rounds(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.normal(size=6) * [5, 4, 3, 2, 1, 0.5]], 0) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    vectors, dimension = w.fit_list(df.repartition(40), "embedding")
    n, sums = w.column_sums(vectors, dimension)
    spread = vectors.repartition(40)
    r = w.triangular_factor(spread, dimension, n, sums)
    x = np.array([row["x"] for row in vectors.collect()], dtype=float)
    centred = x - x.mean(axis=0)
    assert np.allclose(r.T @ r, centred.T @ centred, rtol=1e-12)


def test_hard_cases(spark):
    one = [(i, [0.5, -0.25, 1.0], 0) for i in range(3)]
    df = spark.createDataFrame(one, SCHEMA)
    rows = w.whiten(df, w.fit(df)).collect()
    assert len(rows) == 9 and all((r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) == (1, 0, 0.0, 0.0, 0.0) for r in rows)
    empty = df.limit(0)
    assert w.fit(empty) is None and w.whiten(empty, None).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    nothing = spark.createDataFrame([(1, None, 0), (2, [], 0), (3, [float("nan")], 0)], SCHEMA)
    assert w.whiten(nothing, w.fit(nothing)).count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0], 0) for i in range(9)], SCHEMA)
    found = w.whiten(line, w.fit(line)).collect()
    assert all(r["whitened"] == 0 and r["explained"] == 0 for r in found if r["component"] > 1)
    assert all(math.isclose(r["explained"], 1) for r in found if r["component"] == 1)
    clashing = df.withColumns({"n": F.lit(1), "x": F.lit(2), "v": F.lit(3), "id": F.lit(4), "component": F.lit(5)})
    assert sorted(map(tuple, w.whiten(clashing, w.fit(clashing)).collect())) == sorted(map(tuple, rows))


def test_wide_integers_stay_exact(spark):
    x = np.array([[2**40, -(2**40)], [2**41 + 1, 5]], dtype=np.int64)
    n, sums = 3, [7, 2**42]
    want = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
    assert w.deviations(x, n, sums) == [v if v < 1 << 63 else None for v in want]
    assert w.deviations(x // 2**20, n, [7, 9]) == [sum((n * int(a) - s) ** 2 for a, s in zip(row, (7, 9))) for row in x // 2**20]
