"""Embedding whitening by polarisation covariance.

Vectors become integers.  One pass sums them by dimension; a second one sums, for every
dimension and for every sum of two dimensions, the squares of the centred values - in exact
integers.  As var(a + b) = var(a) + var(b) + 2 cov(a, b), differences of these variances give
every covariance, exactly; the matrix is assembled on the driver (dimensions x dimensions,
whatever the number of rows) and decomposed there.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import pieces

#: An entry c becomes floor(SCALE * c) + SHIFT; entries of LIMIT and more don't fit a long and count as not finite.
SCALE, SHIFT, LIMIT = 64, 1_000_000, 2.0 ** 56
#: Components returned, and eigenvalues (as part of the largest) that count as 0: their rows are not whitened.
COMPONENTS, NEGLIGIBLE = 32, 1e-12
#: Bytes of vectors in one step of a task.
STEP_BYTES = 1 << 20


def usable_vectors(rows: DataFrame, id_col: str, vector_col: str, limit: float = LIMIT) -> DataFrame:
    """(id, v): vectors as doubles; null ones and those with null, non-finite or too large entries (``limit`` and more) are left out."""
    vectors = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < limit))  # NaN is above everything
    return vectors.filter(F.col("v").isNotNull() & (F.size("v") > 0) & fine)


def usual_dimension(vectors: DataFrame) -> int:
    """The most frequent length of ``v`` (of equally frequent ones the largest), 0 without rows."""
    row = vectors.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return row["d"] if row else 0


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """(rows, dimension) doubles of a list column whose lists all have that length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _integers(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in pieces(batches, STEP_BYTES):
        yield batch, np.floor(matrix(batch.column("v"), dimension) * SCALE).astype(np.int64)


def _exact_sum(x: np.ndarray, square: bool = False) -> np.ndarray:
    """Column sums (of squares) as Python integers; in 64 bits where they fit, beyond otherwise."""
    if not len(x):
        return np.zeros(x.shape[1], object)
    most = int(np.abs(x).max())
    if (most ** 2 if square else most) * len(x) >= 1 << 62:
        x = x.astype(object)
    return (np.einsum("ij,ij->j", x, x) if square and x.dtype != object else (x * x if square else x).sum(axis=0)).astype(object)


class Moments:
    """n, the exact sums S of x by dimension, and the exact sums P of products of values centred at floor(S / n)."""

    def __init__(self, n: int, sums: list[int], products: np.ndarray):
        self.n, self.sums, self.products = n, sums, products

    def covariance(self) -> np.ndarray:
        """Of x, divisor n: exact fractions, each rounded once to double."""
        rest = [s % self.n for s in self.sums]  # what the floor leaves of n times the mean
        size = len(rest)
        return np.array([[float(Fraction(self.n * int(self.products[i, j]) - rest[i] * rest[j], self.n ** 2))
                          for j in range(size)] for i in range(size)]).reshape(size, size)


def polarised_moments(vectors: DataFrame, dimension: int) -> Moments:
    """Exact first and second moments of the integer vectors, in two passes of map-side sums."""
    spark = vectors.sparkSession

    def first(batches):
        n, total = 0, np.zeros(dimension, object)
        for _, u in _integers(batches, dimension):
            n, total = n + len(u), total + _exact_sum(u)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(dimension), pa.int32()), pa.array([n] * dimension, pa.int64()),
                                              pa.array(total.tolist(), pa.decimal128(38, 0))], names=["i", "n", "s"])

    got = (vectors.mapInArrow(first, "i int, n long, s decimal(38,0)").groupBy("i")
           .agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s")).orderBy("i").collect())
    if not got:
        return Moments(0, [SHIFT] * 0, np.zeros((0, 0), object))
    n, sums = got[0]["n"], [int(r["s"]) for r in got]
    given = spark.sparkContext.broadcast(np.array([s // n for s in sums], np.int64))

    def second(batches):
        centre = given.value
        totals = [np.zeros(dimension - k, object) for k in range(dimension)]
        any_row = False
        for _, u in _integers(batches, dimension):
            any_row, u = True, u - centre
            totals[0] += _exact_sum(u, square=True)
            for k in range(1, dimension):  # sums of dimensions i and i + k
                totals[k] += _exact_sum(u[:, :-k] + u[:, k:], square=True)
        if any_row:
            for k, t in enumerate(totals):
                yield pa.RecordBatch.from_arrays([pa.array(range(len(t)), pa.int32()), pa.array([k] * len(t), pa.int32()),
                                                  pa.array(t.tolist(), pa.decimal128(38, 0))], names=["i", "k", "q"])

    squares = vectors.mapInArrow(second, "i int, k int, q decimal(38,0)").groupBy("i", "k").agg(F.sum("q").cast("decimal(38,0)").alias("q"))
    products = np.zeros((dimension, dimension), object)
    rows = squares.collect()  # dimensions x (dimensions + 1) / 2
    for r in rows:
        if r["k"] == 0:
            products[r["i"], r["i"]] = int(r["q"])
    for r in rows:
        if r["k"]:
            i, j = r["i"], r["i"] + r["k"]
            products[i, j] = products[j, i] = (int(r["q"]) - products[i, i] - products[j, j]) // 2
    return Moments(n, [s + n * SHIFT for s in sums], products)


class Whitener:
    """Mean, unit eigenvectors (columns, by falling eigenvalue), their whitening scales (nan: none) and shares of the trace."""

    def __init__(self, moments: Moments, components: int = COMPONENTS):
        v = moments.covariance()
        values, vectors = np.linalg.eigh(v)
        order = np.argsort(-values, kind="stable")[:components]
        self.n, self.sums = moments.n, moments.sums
        self.vectors, values = vectors[:, order], values[order]
        alive = values > NEGLIGIBLE * max(values.max(initial=0), 0)
        self.scales = np.where(alive, 1 / np.sqrt(np.where(alive, values, 1)), np.nan)
        trace = np.trace(v)
        self.shares = np.maximum(values, 0) / trace if trace > 0 else np.full(len(values), np.nan)
        # x - S/n = (x - floor(S/n)) - rest/n: small integers, so nothing is lost to the size of x
        self.centre = np.array([s // moments.n - SHIFT for s in moments.sums], np.int64)
        self.rest = np.array([s % moments.n / moments.n for s in moments.sums])

    def apply(self, u: np.ndarray) -> np.ndarray:
        """Whitened components of integer vectors (without SHIFT); nan where the eigenvalue is 0."""
        return ((u - self.centre) - self.rest) @ self.vectors * self.scales

    def deviation(self, u: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact; None beyond a long."""
        y_most = self.n * (int(np.abs(u - self.centre).max(initial=0)) + 1)
        if y_most ** 2 * u.shape[1] < 1 << 62:
            y = (u - self.centre) * self.n - np.array([s % self.n for s in self.sums], np.int64)
            return np.einsum("ij,ij->i", y, y).tolist()
        y = (u - self.centre).astype(object) * self.n - np.array([s % self.n for s in self.sums], object)
        return [int(x) if x < 1 << 63 else None for x in (y * y).sum(axis=1)]


def identity_error(vectors: DataFrame, whitener: Whitener) -> float | None:
    """Largest absolute entry of the whitened rows' covariance (measured over all rows) minus the identity."""
    dimension = whitener.vectors.shape[0]
    alive = np.flatnonzero(np.isfinite(whitener.scales))
    if not len(alive):
        return None
    given = vectors.sparkSession.sparkContext.broadcast(whitener)

    def products(batches):
        total, sums = 0, 0
        for _, u in _integers(batches, dimension):
            w = given.value.apply(u)[:, alive]
            total, sums = total + w.T @ w, sums + w.sum(axis=0)
        if not np.isscalar(total):
            total = np.vstack([total, sums])
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())],
                                             names=["i", "j", "w"])

    got = np.zeros((len(alive) + 1, len(alive)))
    for r in vectors.mapInArrow(products, "i int, j int, w double").groupBy("i", "j").agg(F.sum("w").alias("w")).collect():
        got[r["i"], r["j"]] = r["w"] / whitener.n
    return float(np.abs(got[:-1] - np.outer(got[-1], got[-1]) - np.eye(len(alive))).max())


SCHEMA = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten_embeddings(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                      components: int = COMPONENTS) -> DataFrame:
    """One row per usable row and component: id, component (from 1), n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, empty or holds null, non-finite or too large entries (2^56 and
    more: no long) are left out, and so are vectors of other than the most frequent length.
    Repeated rows and ids count as rows of their own.  Components are as many as dimensions,
    ``components`` at most.  A component without variance has explained 0 and whitened null;
    if none has any (one row, equal rows), explained and identity_error are null as well.  A
    deviation beyond a long is null.  An empty table gives no rows; other columns are ignored,
    whatever their names.
    """
    vectors = usable_vectors(rows, id_col, vector_col)
    schema = f"`{id_col}` {vectors.schema['id'].dataType.simpleString()}, {SCHEMA}"
    dimension = usual_dimension(vectors)
    if not dimension:
        return rows.sparkSession.createDataFrame([], schema)
    vectors = vectors.filter(F.size("v") == dimension)
    whitener = Whitener(polarised_moments(vectors, dimension), components)
    error = identity_error(vectors, whitener)
    given = rows.sparkSession.sparkContext.broadcast(whitener)

    def out(batches):
        own = given.value
        width = len(own.scales)
        for batch, u in _integers(batches, dimension):
            n_rows = len(u)
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(pa.array(np.repeat(np.arange(n_rows), width))),
                pa.array(np.tile(np.arange(1, width + 1), n_rows), pa.int32()), pa.array(np.full(n_rows * width, own.n), pa.int64()),
                pa.array(own.deviation(u), pa.int64()).take(pa.array(np.repeat(np.arange(n_rows), width))),
                pa.array(own.apply(u).ravel(), from_pandas=True), pa.array(np.tile(own.shares, n_rows), from_pandas=True),
                pa.array([error] * (n_rows * width), pa.float64())],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(out, schema)
