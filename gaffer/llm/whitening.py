"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi.

Every entry c of a vector becomes the whole number floor(64 c) + 1000000. The scatter of
these codes about their mean is summed in two passes: sums per dimension, then products of
centred vectors, added up in each task and once more per row of the matrix. The
covariance V (scatter / n) is factored as P L L' P' with diagonal pivoting, which stops
at V's numerical rank; one-sided Jacobi rotates pairs of columns of the triangular factor L until
all are orthogonal. The squares of the rotated columns' norms are V's eigenvalues, the
normalised columns (rows put back by P) its unit eigenvectors. Rotations on the factor rather than
on V keep small eigenvalues accurate.

The d x d covariance and the factorisation are all that the driver handles; d is the
number of dimensions (up to ``MOST_DIMENSIONS``) and does not grow with the rows.

Centring is exact: codes minus the floor of their mean are whole numbers, and the remaining fraction of the
mean is subtracted as a double. ``deviation`` is computed in whole numbers, of any size if needed.

Defined cases: vectors that are null, empty or hold null or non-finite entries, or entries whose
code does not fit (64 |c| beyond 2^53), take no part; vectors of another length than
the commonest (the longer of two equally common ones) take no part; rows with a null or repeated
vec_id each count and keep their id; components of no variance beyond rounding (V's rank) are
left out, so equal vectors or one vector give no rows; a ``deviation`` that does not fit a
long is null; the sign of a component makes its entry of greatest size positive; other columns are
ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaffer.llm.common import stored

SCALE, OFFSET = 64, 1_000_000
MOST_DIMENSIONS = 4096
COMPONENTS = 32
LIMIT = float(1 << 53)


def usable(df: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """(vec_id, vector): the rows that take part, of the commonest length."""
    vector = F.col(vector_col)
    if df.select(vector).schema[0].dataType.simpleString() != "array<float>":
        vector = vector.cast("array<double>")
    rows = stored(df.select(F.col(id_col).alias("vec_id"), vector.alias("vector")).where(
        F.col("vector").isNotNull() & (F.size("vector") > 0)
        & F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) * SCALE <= LIMIT))),
        "whitening-vectors")
    lengths = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head(1)
    d = lengths[0]["d"] if lengths else 0
    if d > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {d} dimensions; at most {MOST_DIMENSIONS} are supported")
    return rows.where(F.size("vector") == d)


def codes_of(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * flat.reshape(len(column), -1)).astype(np.int64) + OFFSET


def _sums(batches):
    """(dimension, n, sum of codes, least, most) over a task's vectors."""
    n, total, low, high = 0, None, None, None
    for b in batches:
        if not b.num_rows:
            continue
        x = codes_of(b.column(0))
        # sums of 2^32 parts and rests can't overflow
        part, rest = np.divmod(x, 1 << 32)
        add = np.array([int(p) * (1 << 32) + int(r) for p, r in zip(part.sum(0), rest.sum(0))], object)
        if total is None:
            n, total, low, high = len(x), add, x.min(0), x.max(0)
        else:
            n, total, low, high = n + len(x), total + add, np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
    if total is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total), pa.int64()),
             pa.array([str(t) for t in total], pa.string()), pa.array(low), pa.array(high)],
            names=["dimension", "n", "total", "low", "high"])


def sums(vectors: DataFrame) -> tuple[int, list[int], list[int], list[int]]:
    """(n, S, least and greatest code) per dimension."""
    parts = vectors.select("vector").mapInArrow(_sums, "dimension int, n long, total string, low long, high long")
    rows = parts.groupBy("dimension").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"),
                                          F.min("low").alias("low"), F.max("high").alias("high")).orderBy("dimension").collect()
    return (rows[0]["n"] if rows else 0, *[[int(r[c]) for r in rows] for c in ("total", "low", "high")])


class Centre:
    """The mean S / n of the codes as a whole number and a fraction."""

    def __init__(self, n: int, total: list[int]):
        self.whole = np.array([t // n for t in total], np.int64)
        self.fraction = np.array([(t % n) / n for t in total])

    def apply(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.fraction


def _matrix_rows(total: np.ndarray):
    return pa.RecordBatch.from_arrays(
        [pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["row", "products"])


def _products(vectors_of):
    """Sum over a task's vectors y of y y', row by row."""
    def run(batches):
        total = None
        for b in batches:
            if b.num_rows:
                y = vectors_of(b)
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield _matrix_rows(total)
    return run


def _add_rows(batches):
    """Sums of equal rows of the tasks' matrices."""
    held: dict[int, np.ndarray] = {}
    for b in batches:
        for row, products in zip(b.column(0).to_pylist(), b.column(1)):
            p = products.values.to_numpy()
            held[row] = held[row] + p if row in held else p
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int32()), pa.array(list(held.values()), pa.list_(pa.float64()))], names=["row", "products"])


def scatter(vectors: DataFrame, vectors_of) -> np.ndarray:
    """Sum of y y' over all vectors; a task adds up its own, then each row is added
    up by one task, from one array per task."""
    schema = "row int, products array<double>"
    parts = vectors.mapInArrow(_products(vectors_of), schema)
    rows = parts.repartition("row").mapInArrow(_add_rows, schema).orderBy("row").collect()
    return np.array([r["products"] for r in rows])


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, L) with a[order][:, order] = L L', L lower triangular with as many
    columns as a's numerical rank."""
    a, n = a.copy(), len(a)
    order, factor = np.arange(n), np.zeros((n, n))
    floor = n * np.finfo(float).eps * np.diag(a).max(initial=0.0)
    for k in range(n):
        p = k + int(np.diag(a)[k:].argmax())
        if a[p, p] <= floor:
            return order, factor[:, :k]
        for m in (a, factor):
            m[[k, p]] = m[[p, k]]
        a[:, [k, p]] = a[:, [p, k]]
        order[[k, p]] = order[[p, k]]
        factor[k, k] = np.sqrt(a[k, k])
        factor[k + 1:, k] = a[k + 1:, k] / factor[k, k]
        a[k + 1:, k + 1:] -= np.outer(factor[k + 1:, k], factor[k + 1:, k])
    return order, factor


def rounds(n: int):
    """Every pair of n columns once, in rounds of disjoint pairs."""
    ring = list(range(n + n % 2))
    for _ in range(len(ring) - 1):
        pairs = [(a, b) for a, b in zip(ring[:len(ring) // 2], ring[::-1]) if max(a, b) < n]
        yield np.array([min(p) for p in pairs], int), np.array([max(p) for p in pairs], int)
        ring = [ring[0], ring[-1], *ring[1:-1]]


def one_sided_jacobi(g: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """g with its columns rotated in pairs until they are orthogonal."""
    g = g.copy()
    eps = np.finfo(float).eps * np.sqrt(len(g))
    for _ in range(sweeps):
        turned = False
        for i, j in rounds(g.shape[1]):
            x, y = g[:, i], g[:, j]
            a, b, c = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            todo = np.abs(c) > eps * np.sqrt(a * b)
            if not todo.any():
                continue
            turned = True
            i, j, a, b, c = i[todo], j[todo], a[todo], b[todo], c[todo]
            zeta = (b - a) / (2 * c)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cos = 1 / np.hypot(1.0, t)
            sin = cos * t
            x, y = g[:, i], g[:, j]
            g[:, i], g[:, j] = cos * x - sin * y, sin * x + cos * y
        if not turned:
            return g
    raise RuntimeError("rotations did not converge")


def components(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) up to the rank."""
    order, factor = pivoted_cholesky(covariance)
    g = one_sided_jacobi(factor)
    norms = np.sqrt((g * g).sum(0))
    falling = np.argsort(-norms, kind="stable")
    vectors = np.empty_like(g)
    vectors[order] = g[:, falling] / norms[falling]
    vectors *= np.where(vectors[np.abs(vectors).argmax(0), range(vectors.shape[1])] < 0, -1.0, 1.0) if vectors.size else 1.0
    return norms[falling] ** 2, vectors


def deviations(x: np.ndarray, n: int, total: list[int], small: bool) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2 of each row; ``small``: fits in longs."""
    if small:
        y = n * x - np.array(total, np.int64)
        return (y * y).sum(1).tolist()
    exact = [sum((n * v - t) ** 2 for v, t in zip(row, total)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


class Whitening:
    """A fitted whitening: mean, components and eigenvalues of the codes."""

    def __init__(self, vectors: DataFrame):
        self.n, self.total, low, high = sums(vectors)
        self.values, self.axes, self.explained = np.zeros(0), np.zeros((len(self.total), 0)), np.zeros(0)
        self.identity_error = 0.0
        if not self.n:
            return
        far = [max(self.n * h - t, t - self.n * m) for t, m, h in zip(self.total, low, high)]
        self.small = self.n * max(map(abs, [*low, *high])) < 1 << 62 and sum(f * f for f in far) < 1 << 63
        self.centre = Centre(self.n, self.total)
        centre = self.centre
        covariance = scatter(vectors.select("vector"), lambda b: centre.apply(codes_of(b.column(0)))) / self.n
        covariance = (covariance + covariance.T) / 2
        values, axes = components(covariance)
        self.values, self.axes = values[:COMPONENTS], axes[:, :COMPONENTS]
        self.explained = self.values / np.trace(covariance) if len(values) else self.values
        if len(values):
            self.identity_error = self.measure(vectors)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centre.apply(x) @ self.axes / np.sqrt(self.values)

    def measure(self, vectors: DataFrame) -> float:
        """Largest entry of the whitened vectors' covariance minus the identity."""
        # a column of ones beside them sums the vectors: the last row is n times the mean
        def extended(b):
            w = self.whiten(codes_of(b.column(0)))
            return np.concatenate([w, np.ones((len(w), 1))], 1)
        s = scatter(vectors.select("vector"), extended) / self.n
        covariance = s[:-1, :-1] - np.outer(s[-1, :-1], s[-1, :-1])  # the mean is 0 but for rounding
        return float(np.abs(covariance - np.eye(len(covariance))).max())

    def transform(self, vectors: DataFrame) -> DataFrame:
        """vec_id, deviation, whitened (array, by component)."""
        n, total = self.n, self.total

        def run(batches):
            for b in batches:
                if b.num_rows:
                    x = codes_of(b.column(1))
                    w = self.whiten(x)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0), pa.array(deviations(x, n, total, self.small), pa.int64()),
                         pa.array(list(w), pa.list_(pa.float64()))], names=["vec_id", "deviation", "whitened"])
        id_type = vectors.schema["vec_id"].dataType.simpleString()
        out = f"vec_id {id_type}, deviation long, whitened array<double>"
        if not len(self.values):
            return vectors.sparkSession.createDataFrame([], out)
        return vectors.select("vec_id", "vector").mapInArrow(run, out)


def whitened(df: DataFrame) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per
    vector and component."""
    vectors = usable(df)
    fitted = Whitening(vectors)
    shares = F.array(*[F.lit(float(e)) for e in fitted.explained]).cast("array<double>")
    rows = fitted.transform(vectors).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation",
                       "whitened", F.get(shares, F.col("at")).alias("explained"),
                       F.lit(fitted.identity_error).alias("identity_error"))
