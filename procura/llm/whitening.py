"""Embedding whitening by blockwise QR, Householder bidiagonalisation, dqds and twisted factorisations.

Components become whole numbers ``x = floor(1024 c) + 100000``; ``n`` rows with sums ``S`` are the fit list.  Rows are
centred exactly (``(n x - S) / n``, from whole numbers), reduced by QR block by block to one ``d x d`` triangle
``R`` a task, and the triangles pairwise in Spark to a last one: ``R'R`` is ``n`` times the covariance, and never formed.
On the driver (``d x d`` numbers, ``d`` the vectors' length) ``R`` becomes bidiagonal by Householder reflections, dqds
finds its singular values to high relative accuracy, and each right vector comes from a twisted factorisation of
``B'B - s**2``, entered where its pivot is least.  Vectors of close values are made orthogonal within their cluster.

Result, a row for each vector and component: ``whitened`` is the centred row on the component over ``sqrt(e)``,
``e = s**2 / n``; ``explained`` is ``e`` over the covariance's trace; ``identity_error`` is measured over all rows.

Rules: vectors that are null, hold null or non-finite entries or entries whose ``x`` passes 61 bits, are empty or of another
length than most rows' (the shorter, if as many) take no part; repeated ids and rows count each for itself; components
whose singular value is below ``SMALLEST`` of the largest have no direction and are left out, so fewer than ``components``
may come, and none if all vectors are equal; an empty table gives no rows; extra columns are ignored.  ``deviation`` is null where it
passes 64 bits; ``deviation_wide`` (decimal) never is.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, pick, staged

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
BLOCK_ROWS = 4096
#: Singular values below this share of the largest are rounding.
SMALLEST = 1e-11
_EPS = np.finfo(float).eps


# --- singular values and vectors of a d x d triangle ---------------------------------------


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right factor V of ``U' r V`` (upper bidiagonal), by Householder reflections."""
    a, d = r.astype(float).copy(), len(r)
    v = np.eye(d)

    def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
        size = np.linalg.norm(x)
        if size == 0:
            return x, 0.0
        w = x.copy()
        w[0] += np.copysign(size, x[0])
        return w, 2.0 / (w @ w)

    for k in range(d):
        w, beta = reflector(a[k:, k])
        a[k:, k:] -= beta * np.outer(w, w @ a[k:, k:])
        if k + 2 < d:
            w, beta = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= beta * np.outer(a[k:, k + 1 :] @ w, w)
            v[:, k + 1 :] -= beta * np.outer(v[:, k + 1 :] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _dqds_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float]:
    """One differential qd transform with a shift; the least pivot tells whether the shift was below all values."""
    n = len(q)
    nq, ne = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - shift
    least = d
    for i in range(n - 1):
        nq[i] = d + e[i]
        if nq[i] == 0.0:
            ne[i], d = 0.0, q[i + 1] - shift
        else:
            ratio = q[i + 1] / nq[i]
            ne[i] = e[i] * ratio
            d = d * ratio - shift
        least = min(least, d)
    nq[n - 1] = d
    return nq, ne, least


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Singular values of an upper bidiagonal matrix, falling."""
    q, e = [float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above]
    top = max([*q, *e, 0.0])
    if top == 0.0:
        return np.zeros(len(q))
    found: list[float] = []
    blocks = [(q, e, 0.0)]
    tiny = np.finfo(float).tiny * 4
    while blocks:
        q, e, moved = blocks.pop()
        turns = 0
        while len(q) > 1:
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= (10 * _EPS) ** 2 * (moved + q[i]) or e[i] < tiny), None)
            if cut == len(e) - 1:
                found.append(moved + max(q.pop(), 0.0))
                e.pop()
                continue
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if 1.5 * q[0] < q[-1]:  # the small values belong at the end
                q, e = q[::-1], e[::-1]
            # The last two by two block's smaller value is a shift from above; less of it until the pivots stay positive.
            a, b, c = q[-2], e[-1], q[-1]
            half = (a + b + c) / 2
            root = np.sqrt(max(half * half - a * c, 0.0))
            shift = min(a * c / (half + root) if half + root > 0 else 0.0, min(q)) * (0.0 if turns == 0 else 1.0)
            turns += 1
            while True:
                nq, ne, least = _dqds_step(q, e, shift)
                if least >= 0.0 or shift == 0.0:
                    break
                shift = shift / 4 if shift > _EPS * (moved + min(q)) else 0.0
            q, e, moved = nq, ne, moved + shift
        found.extend(moved + max(x, 0.0) for x in q)
    return np.sqrt(np.sort(np.array(found))[::-1])


def _twisted(diagonal: np.ndarray, above: np.ndarray, value: float):
    """Twisted factorisations of ``B'B - value``: multipliers from both ends and the pivot at every entry."""
    n = len(diagonal)
    q, e = diagonal * diagonal, above * above
    off = diagonal[:-1] * above
    floor = _EPS * max(float(q.max()), float(e.max()) if n > 1 else 0.0) * _EPS
    safe = lambda x: x if abs(x) > floor else (floor or np.finfo(float).tiny)
    down, up = np.zeros(max(n - 1, 0)), np.zeros(max(n - 1, 0))
    s, p = np.zeros(n), np.zeros(n)
    s[0] = -value
    for i in range(n - 1):  # stationary, from the top
        pivot = safe(s[i] + q[i])
        down[i] = off[i] / pivot
        s[i + 1] = (e[i] / pivot) * s[i] - value
    p[n - 1] = q[n - 1] - value
    for i in range(n - 2, -1, -1):  # progressive, from the bottom
        pivot = safe(p[i + 1] + e[i])
        up[i] = off[i] / pivot
        p[i] = (q[i] / pivot) * p[i + 1] - value
    return down, up, s + p + value


def _vector(down: np.ndarray, up: np.ndarray, at: int) -> np.ndarray:
    """The null vector of the factorisation twisted at an entry (whose pivot is taken as zero)."""
    z = np.zeros(len(down) + 1)
    z[at] = 1.0
    for i in range(at - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
        if abs(z[i]) > 1e100:
            z /= abs(z[i])
    for i in range(at, len(down)):
        z[i + 1] = -up[i] * z[i]
        if abs(z[i + 1]) > 1e100:
            z /= abs(z[i + 1])
    return z / np.linalg.norm(z)


def right_vectors(diagonal: np.ndarray, above: np.ndarray, singular: np.ndarray, close: float = 1e-3) -> np.ndarray:
    """A column for each of the (falling) singular values."""
    out = np.zeros((len(diagonal), len(singular)))
    first = 0
    for k, value in enumerate(singular):
        if k and singular[k - 1] - value > close * singular[k - 1]:
            first = k
        down, up, gamma = _twisted(diagonal, above, float(value) ** 2)
        best, most = None, -1.0
        # Where the pivot is least; the next ones only if what is left beside the cluster's vectors is too little.
        for at in np.argsort(np.abs(gamma), kind="stable"):
            z = _vector(down, up, int(at))
            left = z
            for _ in range(2):
                left = left - out[:, first:k] @ (out[:, first:k].T @ left)
            size = float(np.linalg.norm(left))
            if size > most:
                best, most = left / size if size else left, size
            if size > 0.5:
                break
        out[:, k] = best
    return out


def components_of(r: np.ndarray, n: int, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float]:
    """Directions (columns), their eigenvalues and the trace of the covariance ``r'r / n``."""
    diagonal, above, v = bidiagonal(r)
    singular = dqds(diagonal, above)
    trace = float((r * r).sum()) / n
    kept = singular[:most][singular[:most] > SMALLEST * singular[0]] if len(singular) else singular
    if not len(kept):
        return np.zeros((len(r), 0)), kept, trace
    return v @ right_vectors(diagonal, above, kept), kept * kept / n, trace


# --- Spark -----------------------------------------------------------------------------------


class Whole:
    """Vectors as whole numbers: x less the mean's floor, which is exact and small."""

    def __init__(self, n: int, total: list[int]):
        self.n, self.d = n, len(total)
        self.floor = np.array([s // n for s in total], np.int64)
        self.rest = np.array([s % n for s in total], object)

    def shifted(self, column: pa.Array) -> np.ndarray:
        c = np.asarray(column.flatten(), np.float64).reshape(len(column), self.d)
        return np.floor(SCALE * c).astype(np.int64) + SHIFT - self.floor

    def centred(self, shifted: np.ndarray) -> np.ndarray:
        return shifted - (self.rest / self.n).astype(float)

    def deviations(self, shifted: np.ndarray) -> list[int] | np.ndarray:
        """Sum over dimensions of (n x - S)**2, exact."""
        largest = int(np.abs(shifted).max(initial=0)) * self.n + self.n
        if largest * largest * self.d < 2**63:
            return ((shifted * self.n - self.rest.astype(np.int64)) ** 2).sum(1)
        return list(((shifted.astype(object) * self.n - self.rest) ** 2).sum(1))


def _rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, vec: rows that may take part."""
    rows = pick(vectors, vec_id=id_col, vec=vector_col)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vec").cast("array<double>").alias("vec"))
    fits = F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(2.0**51)))
    return rows.filter(F.col("vec").isNotNull() & (F.size("vec") > 0) & fits)


def _totals(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """Rows and exact sums of every dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for batch in batches:
            c = np.asarray(batch.column(0).flatten(), np.float64).reshape(batch.num_rows, d)
            x = np.floor(SCALE * c).astype(np.int64) + SHIFT
            exact = x if np.abs(x).max(initial=0) < 2**40 else x.astype(object)
            n, total = n + batch.num_rows, [a + int(b) for a, b in zip(total, exact.sum(0))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([n] * d, pa.int64()), pa.array(range(d), pa.int32()), pa.array(map(Decimal, total), pa.decimal128(38, 0))],
            ["n", "dim", "total"],
        )

    sums = rows.select("vec").mapInArrow(run, "n long, dim int, total decimal(38,0)")
    found = sums.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("dim").collect()  # d rows
    return (int(found[0].n), [int(r.total) for r in found]) if found else (0, [])


def _triangle(rows: DataFrame, whole: Whole, fan_in: int = 32) -> np.ndarray:
    """R of the centred rows: a triangle for each task, then triangles in groups of ``fan_in`` until one is left."""
    d = whole.d

    def reduce(r: np.ndarray, block: np.ndarray) -> np.ndarray:
        return np.linalg.qr(np.vstack([r, block]), mode="r")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for batch in batches:
            centred = whole.centred(whole.shifted(batch.column(0)))
            for lo in range(0, len(centred), BLOCK_ROWS):
                r = reduce(r, centred[lo : lo + BLOCK_ROWS])
        if len(r):
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([r.ravel().tolist()], pa.list_(pa.float64()))], ["part", "r"]
            )

    def merge(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        r = np.zeros((0, d))
        for flat in parts.sort_values("part")["r"]:
            r = reduce(r, np.asarray(flat, float).reshape(-1, d))
        return pd.DataFrame({"part": [int(key[0])], "r": [r.ravel()]})

    triangles = staged(rows.select("vec").mapInArrow(run, "part int, r array<double>"), "triangles")
    while triangles.filter("part > 0").count():
        merged = triangles.groupBy((F.col("part") / F.lit(fan_in)).cast("int").alias("group")).applyInPandas(
            merge, "part int, r array<double>"
        )
        merged = staged(merged, "triangles")
        discard(triangles)
        triangles = merged
    flat = triangles.collect()  # one triangle
    discard(triangles)
    r = np.zeros((0, d)) if not flat else np.asarray(flat[0].r, float).reshape(-1, d)
    return np.vstack([r, np.zeros((d - len(r), d))])


def _identity_error(rows: DataFrame, whole: Whole, matrix: np.ndarray) -> float:
    """Largest entry of the whitened rows' covariance less the identity, from moments merged around their means."""
    k = matrix.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, spread = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = whole.centred(whole.shifted(batch.column(0))) @ matrix
            if not len(w):
                continue
            own = w.mean(0)
            off, both = own - mean, n + len(w)
            spread += (w - own).T @ (w - own) + np.outer(off, off) * (n * len(w) / both)
            mean, n = mean + off * (len(w) / both), both
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays(
            [pa.array([n] * len(i), pa.int64()), pa.array(i, pa.int32()), pa.array(j, pa.int32()),
             pa.array(spread[i, j]), pa.array(mean[i]), pa.array(mean[j])],
            ["n", "i", "j", "spread", "mi", "mj"],
        )

    parts = rows.select("vec").mapInArrow(run, "n long, i int, j int, spread double, mi double, mj double")
    total = F.sum("n")
    # Between tasks: sum of n mi mj less the product of the sums over n.
    covariance = (F.sum("spread") + F.sum(F.col("n") * F.col("mi") * F.col("mj"))
                  - F.sum(F.col("n") * F.col("mi")) * F.sum(F.col("n") * F.col("mj")) / total) / total
    error = F.abs(covariance - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0))
    return float(parts.groupBy("i", "j").agg(error.alias("error")).agg(F.max("error")).first()[0])


_RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, "
           "deviation_wide decimal(38,0)")


def whiten(vectors: DataFrame, *, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, deviation_wide."""
    rows = _rows(vectors, id_col, vector_col)
    size = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    empty = rows.sparkSession.createDataFrame([], _RESULT)
    if size is None:
        return empty
    rows = rows.filter(F.size("vec") == F.lit(size.d))
    whole = Whole(*_totals(rows, size.d))
    n = whole.n
    directions, values, trace = components_of(_triangle(rows, whole), n, components)
    k = len(values)
    if not k:
        return empty
    matrix = directions / np.sqrt(values)
    explained = values / trace
    error = _identity_error(rows, whole, matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shifted = whole.shifted(batch.column(1))
            w = whole.centred(shifted) @ matrix
            deviation = whole.deviations(shifted)
            if isinstance(deviation, list):
                narrow = pa.array([int(x) if x < 2**63 else None for x in deviation], pa.int64())
                wide = pa.array([Decimal(int(x)) for x in deviation], pa.decimal128(38, 0))
            else:
                narrow = pa.array(deviation)
                wide = narrow.cast(pa.decimal128(38, 0))
            each, rows_, turn = np.arange(k), len(w), np.repeat(np.arange(len(w)), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(turn)), pa.array(np.tile(each + 1, rows_).astype(np.int32)),
                 pa.array(np.full(rows_ * k, n)), narrow.take(pa.array(turn)), pa.array(w.ravel()),
                 pa.array(np.tile(explained, rows_)), pa.array(np.full(rows_ * k, error)), wide.take(pa.array(turn))],
                [c.split()[0] for c in _RESULT.split(", ")],
            )

    return rows.mapInArrow(run, _RESULT)
