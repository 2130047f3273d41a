"""Whitening of embeddings by a bidiagonal qd solver.

Every entry becomes the integer ``floor(256 * c)``. The fit list holds each distinct vector of such integers once, and
means and covariances are over it. Its centred rows are never gathered: each task reduces its part to a triangular factor
block by block, the factors of tasks are stacked and reduced again in groups until one is left, and that factor, of
the dimension alone, is bidiagonalised by Householder reflections on the driver. The dqds transforms, shifted by a lower
bound of the least value that is left, find the singular values, each to a small relative error. The directions are
eigenvectors of the tridiagonal product, by twisted factorisations: one from the top and one from the bottom meet where
the vector is largest. A row's whitened components are its centred entries along the directions, by the deviations.

Sums and deviations are exact integers. Only numbers per dimension, and one triangular factor, reach the driver.

Cases: rows whose vector is NULL, or holds a NULL, an infinite entry, NaN or an entry beyond 64-bit integers, are
dropped, and so are those of another length than the most frequent one (the smallest of equally frequent ones, empty
vectors aside); repeated rows are one vector of the fit list and keep a result each; a NULL id is kept; with fewer
dimensions than components there are as many components as dimensions; a direction without variance (one distinct vector, say) has
whitened value 0, explains 0 and does not count in the identity error; a deviation beyond 64-bit integers is NULL; an
empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored, tuned_batches

COMPONENTS = 4
SCALE = 256
# Rows that are reduced at once, and triangular factors that are stacked in one task.
BLOCK_ROWS = 4_096
STACKED = 16
EPS = float(np.finfo(float).eps)
# A direction with less of the variance than this has none.
NO_VARIANCE = 64 * EPS


# -- the solver --------------------------------------------------------------------------------------------------------


def bidiagonalised(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) of the upper bidiagonal ``U' r V``, by Householder reflections from both sides."""
    a = np.array(r, dtype=float)
    n = len(a)
    v = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        """The unit vector whose reflection takes ``x`` to a multiple of the first axis."""
        length = np.linalg.norm(x)
        if length == 0 or not x[1:].any():
            return None
        u = x.copy()
        u[0] += np.copysign(length, x[0])
        return u / np.linalg.norm(u)

    for k in range(n):
        if (u := reflector(a[k:, k])) is not None:
            a[k:, k:] -= 2 * np.outer(u, u @ a[k:, k:])
        if k < n - 2 and (u := reflector(a[k, k + 1 :])) is not None:
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ u, u)
            v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ u, u)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One differential quotient-difference transform with a shift: the new q and e, and the differences."""
    d = q[0] - shift
    differences, new_q, new_e = [d], [], []
    for k in range(len(e)):
        new_q.append(d + e[k])
        ratio = q[k + 1] / new_q[k] if new_q[k] else 0.0
        new_e.append(e[k] * ratio)
        d = d * ratio - shift if new_q[k] else q[k + 1] - shift
        differences.append(d)
    new_q.append(d)
    return new_q, new_e, differences


def squared_singular_values(diagonal: np.ndarray, superdiagonal: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, falling."""
    found: list[float] = []
    blocks = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in superdiagonal], 0.0)]
    while blocks:
        q, e, total = blocks.pop()
        bound = 0.0
        while q:
            if len(q) == 1:
                found.append(q[0] + total)
                break
            # Neighbours whose coupling is below rounding are solved apart.
            cut = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= (EPS * EPS) * (q[k] + q[k + 1] + total) or e[k] <= 1e-300), None)
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], total))
                q, e, bound = q[cut + 1 :], e[cut + 1 :], 0.0
                continue
            new = dqds(q, e, bound)
            while bound and min(new[2]) < 0:
                # Rounding took the bound past the least value.
                bound = bound / 2 if bound > EPS * total else 0.0
                new = dqds(q, e, bound)
            total += bound
            q, e, differences = new
            # The inverse has these as the inverses of its diagonal: below their harmonic sum lies no value.
            least = min(differences)
            bound = (1 - 8 * EPS * len(q)) / sum(1 / d for d in differences) if least > 0 else 0.0
            if bound <= EPS * EPS * total:
                bound = 0.0
    return np.maximum(np.sort(np.array(found))[::-1], 0.0)


def twisted(diagonal: np.ndarray, superdiagonal: np.ndarray, value: float) -> Iterator[np.ndarray]:
    """Unit eigenvectors of ``B' B`` for a value, from the best place to twist on.

    ``B' B = L D L'`` is factorised from the top, with its shifts s, and from the bottom, with its shifts p; where the
    two meet the pivot is s + p + value, and the vector that solves for it alone is read off both ways.
    """
    n = len(diagonal)
    tiny = EPS * EPS * max(float(np.max(np.abs(diagonal))), float(np.max(np.abs(superdiagonal), initial=0.0)), 1e-300)
    a = np.where(np.abs(diagonal) < tiny, tiny, diagonal)
    d, low = a * a, superdiagonal / a[:-1]
    pivot = lambda x: x if x else tiny * tiny or 1e-300
    down, up = np.zeros(max(n - 1, 0)), np.zeros(max(n - 1, 0))
    s, p = np.empty(n), np.empty(n)
    s[0] = -value
    for i in range(n - 1):
        down[i] = d[i] * low[i] / pivot(d[i] + s[i])
        s[i + 1] = down[i] * low[i] * s[i] - value
    p[n - 1] = d[n - 1] - value
    for i in range(n - 2, -1, -1):
        if not low[i]:
            p[i] = d[i] - value
            continue
        ratio = d[i] / pivot(d[i] * low[i] * low[i] + p[i + 1])
        up[i] = low[i] * ratio
        p[i] = p[i + 1] * ratio - value
    pivots = np.abs(s + p + value)
    for place in np.argsort(pivots, kind="stable").tolist():
        z = np.zeros(n)
        z[place] = 1.0
        for i in range(place - 1, -1, -1):
            z[i] = -down[i] * z[i + 1]
        for i in range(place, n - 1):
            z[i + 1] = -up[i] * z[i]
        yield z / np.linalg.norm(z)


def principal_directions(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(squares of the largest singular values of ``r``, their right singular vectors as columns, the sum of all squares)."""
    scale = float(np.max(np.abs(r), initial=0.0))
    if not scale:
        return np.zeros(count), np.eye(len(r))[:, :count], 0.0
    diagonal, superdiagonal, v = bidiagonalised(r / scale)
    values = squared_singular_values(diagonal, superdiagonal)
    columns: list[np.ndarray] = []
    for value in values[:count]:
        best, length = np.zeros(len(v)), 0.0
        for z in twisted(diagonal, superdiagonal, float(value)):
            # Vectors of values that lie close together are only told apart by being orthogonal; of equal values in
            # parts that do not touch, a further place to twist finds the next one.
            for _ in range(2):
                for earlier in columns:
                    z = z - earlier * (earlier @ z)
            if (left := float(np.linalg.norm(z))) > length:
                best, length = z / left, left
            if length > 0.1:
                break
        columns.append(best)
    return values[:count] * scale**2, v @ np.array(columns).T, float(values.sum()) * scale**2


# -- on tables ---------------------------------------------------------------------------------------------------------


def quantised(rows: DataFrame, vector_col: str) -> DataFrame:
    """``rows`` with ``x``, the integer vector; only those whose vector is whole and finite."""
    limit = 2.0**62 / SCALE
    entry = lambda c: c.cast("double")
    fits = lambda c: c.isNotNull() & ~F.isnan(entry(c)) & (F.abs(entry(c)) < F.lit(limit))
    vector = F.col(f"`{vector_col}`")
    whole = rows.filter(vector.isNotNull() & F.forall(vector, fits))
    return whole.withColumn("x", F.transform(vector, lambda c: F.floor(F.lit(float(SCALE)) * entry(c)).cast("long")))


def usual_length(rows: DataFrame) -> int | None:
    """The most frequent length of ``x`` above 0."""
    counts = rows.select(F.size("x").alias("length")).filter("length > 0").groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max_by("length", F.struct("n", (-F.col("length")).alias("shorter")))).first()[0]


def matrix(column: pa.ChunkedArray | pa.Array, dimension: int) -> np.ndarray:
    """The vectors of a batch, a row each."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), dimension)


def column_sums(fit: DataFrame, dimension: int) -> tuple[int, list[int]]:
    """(rows, exact sums per dimension) of the fit list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums, greatest = 0, [0] * dimension, 0
        for batch in batches:
            x = matrix(batch.column(0), dimension)
            count += len(x)
            greatest = max(greatest, int(np.abs(x).max(initial=0)))
            exact = x.sum(axis=0) if greatest * max(len(x), 1) < 1 << 62 else x.astype(object).sum(axis=0)
            sums = [a + int(b) for a, b in zip(sums, exact)]
        places = [-1, *range(dimension)]
        amounts = pa.array([str(v) for v in (count, *sums)])
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), amounts], ["place", "amount"])

    parts = fit.mapInArrow(run, "place int, amount string")
    totals = parts.groupBy("place").agg(F.sum(F.col("amount").cast("decimal(38,0)")).alias("amount")).collect()
    found = {row["place"]: int(row["amount"]) for row in totals}
    return found.get(-1, 0), [found.get(k, 0) for k in range(dimension)]


def centred(x: np.ndarray, n: int, sums: Sequence[int]) -> np.ndarray:
    """``x`` less the mean: the integers n * x - sums over n, exact up to the one division where they fit."""
    if (int(np.abs(x).max(initial=0)) * n + max(map(abs, sums), default=0)) < 1 << 62:
        return (x * n - np.array(sums, dtype=np.int64)) / n
    return ((x.astype(object) * n - np.array(sums, dtype=object)) / n).astype(float)


def deviations(x: np.ndarray, n: int, sums: Sequence[int]) -> list[int | None]:
    """Exact sums over the dimensions of (n * x - sums) squared."""
    most = int(np.abs(x).max(initial=0)) * n + max(map(abs, sums), default=0)
    if most * most * x.shape[1] < 1 << 63:
        away = x * n - np.array(sums, dtype=np.int64)
        return np.einsum("ij,ij->i", away, away).tolist()
    away = x.astype(object) * n - np.array(sums, dtype=object)
    return [value if value < 1 << 63 else None for value in (away * away).sum(axis=1).tolist()]


def triangular(stack: np.ndarray, dimension: int) -> np.ndarray:
    """The triangular factor of stacked rows, square."""
    r = np.linalg.qr(stack, mode="r")
    return r if len(r) == dimension else np.vstack([r, np.zeros((dimension - len(r), dimension))])


def triangular_factor(fit: DataFrame, dimension: int, n: int, sums: Sequence[int]) -> np.ndarray:
    """The triangular factor of all centred rows, by a tree of reductions."""

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, dimension))
        for batch in batches:
            x = matrix(batch.column(0), dimension)
            for start in range(0, len(x), BLOCK_ROWS):
                r = triangular(np.vstack([r, centred(x[start : start + BLOCK_ROWS], n, sums)]), dimension)
        if len(r):
            part = pa.array([TaskContext.get().partitionId()], pa.int32())
            yield pa.RecordBatch.from_arrays([part, pa.array([r.tobytes()])], ["part", "factor"])

    def stack(group: pa.Table) -> pa.Table:
        factors = [np.frombuffer(f.as_py()).reshape(-1, dimension) for f in group.sort_by("part").column("factor")]
        r = triangular(np.vstack(factors), dimension)
        part = pa.array([group.column("part")[0].as_py() // STACKED], pa.int32())
        return pa.table({"part": part, "factor": [r.tobytes()]})

    schema = "part int, factor binary"
    factors, _ = stored(fit.mapInArrow(reduce_rows, schema), "whitening-factors")
    while (last := factors.agg(F.max("part")).first()[0]) is not None and last > 0:
        factors, _ = stored(factors.groupBy(F.floor(F.col("part") / STACKED)).applyInArrow(stack, schema), "whitening-factors")
    row = factors.first()
    return np.zeros((dimension, dimension)) if row is None else np.frombuffer(row["factor"]).reshape(dimension, dimension)


@dataclass
class Whitening:
    """A fitted whitening; ``variances`` of 0 stand for directions without any."""

    n: int
    sums: list[int]
    directions: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Whitened components of integer vectors, a row each."""
        some = self.variances > 0
        scale = np.where(some, 1 / np.sqrt(np.where(some, self.variances, 1.0)), 0.0)
        return centred(x, self.n, self.sums) @ self.directions * scale


def measured_error(fit: DataFrame, model: Whitening) -> float:
    """The largest entry of the whitened fit list's covariance minus the identity, over directions with variance."""
    dimension, count = model.directions.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(count), np.zeros((count, count))
        for batch in batches:
            w = model.whitened(matrix(batch.column(0), dimension))
            sums += w.sum(axis=0)
            products += w.T @ w
        amounts = np.concatenate([sums, products.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(amounts)), pa.int32()), pa.array(amounts)], ["place", "amount"])

    rows = fit.mapInArrow(run, "place int, amount double").groupBy("place").agg(F.sum("amount").alias("amount")).collect()
    totals = np.zeros(count + count * count)
    for row in rows:
        totals[row["place"]] = row["amount"]
    mean, products = totals[:count] / model.n, totals[count:].reshape(count, count) / model.n
    some = model.variances > 0
    off = np.abs(products - np.outer(mean, mean) - np.eye(count))[some][:, some]
    return float(off.max(initial=0.0))


def fit_list(rows: DataFrame, vector_col: str) -> tuple[DataFrame, int | None]:
    """(the distinct integer vectors, stored; their length)."""
    whole = quantised(rows.select(F.col(f"`{vector_col}`").alias("v")), "v").select("x")
    dimension = usual_length(whole)
    fit, _ = stored(whole.filter(F.size("x") == F.lit(dimension or 0)).distinct(), "whitening-fit")
    return fit, dimension


def fit(rows: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a table's vectors; None if it has none."""
    tuned_batches(rows.sparkSession)
    vectors, dimension = fit_list(rows, vector_col)
    if dimension is None:
        return None
    n, sums = column_sums(vectors, dimension)
    r = triangular_factor(vectors, dimension, n, sums)
    values, directions, total = principal_directions(r, min(components, dimension))
    has = values > NO_VARIANCE * max(total, 0.0)
    variances = np.where(has, values / n, 0.0)
    explained = np.where(has, values / (total or 1.0), 0.0)
    model = Whitening(n, sums, directions, variances, explained)
    model.identity_error = measured_error(vectors, model)
    return model


def whiten(rows: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id_col, component, n, deviation, whitened, explained, identity_error)`` per row that is whole, and component."""
    tuned_batches(rows.sparkSession)
    kind = rows.select(F.col(f"`{id_col}`").alias("id")).schema["id"].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    dimension, count = model.directions.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), dimension)
            times = np.repeat(np.arange(len(x)), count)
            columns = {
                "id": batch.column(0).take(pa.array(times)),
                "component": pa.array(np.tile(np.arange(1, count + 1), len(x)), pa.int32()),
                "n": pa.array(np.full(len(times), model.n, dtype=np.int64)),
                "deviation": pa.array(deviations(x, model.n, model.sums), pa.int64()).take(pa.array(times)),
                "whitened": pa.array(model.whitened(x).ravel()),
                "explained": pa.array(np.tile(model.explained, len(x))),
                "identity_error": pa.array(np.full(len(times), model.identity_error)),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    pairs = rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("v"))
    whole = quantised(pairs, "v").filter(F.size("x") == F.lit(dimension)).select("id", "x")
    return whole.mapInArrow(run, schema).withColumnRenamed("id", id_col)
