"""Embedding whitening: eigenvectors of the distributed covariance by mixed-precision refinement.

1. Vectors that are null, empty or hold null or non-finite entries are left out, as are
   entries beyond ``LIMIT`` and vectors of another length than most. An entry c becomes the
   integer floor(64 c) + 1000000; counts and sums are exact integers.
2. The covariance is summed from vectors that are centred first: (n x - S) / n, with the
   numerator an exact integer. Tasks send one matrix each, which Spark sums by entry.
3. ``eigh`` of the float32 covariance gives first eigenvectors. Ogita and Aishima's
   iteration corrects them by matrix products in float64. Where eigenvalues lie closer than
   the error of their estimate the iteration can not part them: the small symmetric problem
   of such a cluster, shifted to its mean, is solved by itself and its vectors are turned.
4. Rows are projected in place; one more pass sums the covariance of what came out.

The driver holds matrices of the dimension's size only. Rows never move.

Repeated rows and null ids are rows like any other. A component whose eigenvalue is zero
within rounding can not be scaled: its ``whitened`` is null, and it does not enter
``identity_error``. A ``deviation`` beyond 64 bits is null. An empty table, or one with
no usable vector, gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import small

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
#: Largest entry that is used: its integer times a row count stays far inside 64 bits.
LIMIT = float(2**31)
#: Rows worked on at a time.
ROWS = 500
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def usable(vectors: DataFrame, column: str = "embedding") -> tuple[DataFrame, int]:
    """(``vec_id, v``, dimension): the vectors that take part."""
    v = vectors.select("vec_id", F.col(column).cast("array<double>").alias("v"))
    v = v.filter(F.col("v").isNotNull() & (F.size("v") > 0))
    v = v.filter(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= LIMIT)))
    most = v.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("d")).first()
    d = most["d"] if most else 0
    return v.filter(F.size("v") == d), d


def integers(b: pa.RecordBatch, d: int) -> np.ndarray:
    """The rows of a batch (vec_id, v) as integers."""
    v = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    return np.floor(SCALE * v).astype(np.int64) + SHIFT


class Fit(NamedTuple):
    """What the projection needs: row count, sums, unit eigenvectors by column, eigenvalues, trace."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y = self.n * x - self.sums
        return y, y / self.n

    def scaled(self, k: int) -> np.ndarray:
        """(dimension, k): eigenvectors over the roots of their eigenvalues, nan where that is zero."""
        e = self.values[:k]
        floor = len(self.values) * np.finfo(np.float64).eps * max(float(self.values[0]), 0.0)
        return self.vectors[:, :k] / np.sqrt(np.where(e > floor, e, np.nan))


def _entries(m: np.ndarray) -> pa.RecordBatch:
    i, j = np.triu_indices(len(m))
    return pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(m[i, j])], names=["i", "j", "s"])


def _matrix(entries: DataFrame, d: int) -> np.ndarray:
    """A symmetric matrix from the sums of the tasks' entries: d (d + 1) / 2 rows reach the driver."""
    m = np.zeros((d, d))
    for r in entries.groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["s"]
    return m


def covariance(v: DataFrame, d: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, sums, covariance) of the integer vectors, divisor n, centred before multiplying."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = 0, np.zeros(d, dtype=np.int64)
        for b in small(batches, ROWS):
            x = integers(b, d)
            n, s = n + len(x), s + x.sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array(np.full(d, n)), pa.array(s)], names=["i", "n", "s"])

    total = np.zeros(d, dtype=np.int64)
    n = 0
    for r in v.mapInArrow(sums, "i int, n long, s long").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect():
        total[r["i"]], n = r["s"], r["n"]
    if not n:
        return 0, total, np.zeros((d, d))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, any_ = np.zeros((d, d)), False
        for b in small(batches, ROWS):
            y = (n * integers(b, d) - total) / n
            m, any_ = m + y.T @ y, True
        if any_:
            yield _entries(m)

    return n, total, _matrix(v.mapInArrow(products, "i int, j int, s double"), d) / n


def clusters(values: np.ndarray, width: float) -> list[np.ndarray]:
    """Positions of eigenvalues that lie within ``width`` of a neighbour, group by group."""
    order = np.argsort(-values, kind="stable")
    cut = np.flatnonzero(-np.diff(values[order]) > width) + 1
    return [g for g in np.split(order, cut) if len(g) > 1]


def refine(a: np.ndarray, x: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors) of symmetric ``a`` in falling order, from the approximate vectors ``x``."""
    d, size = len(a), np.linalg.norm(a, 2)
    x = x.astype(np.float64)
    last = np.inf
    for _ in range(rounds):
        r = np.eye(d) - x.T @ x
        s = x.T @ a @ x
        s = (s + s.T) / 2  # rounding that is not symmetric would be divided by the smallest gaps
        values = np.diag(s) / (1.0 - np.diag(r))
        off = s - np.diag(values)
        width = 2 * (np.linalg.norm(off, 2) + size * np.linalg.norm(r, 2))
        gap = values[None, :] - values[:, None]
        far = np.abs(gap) > width
        e = np.where(far, (s + values[None, :] * r) / np.where(far, gap, 1.0), r / 2)
        x = x + x @ e
        for g in clusters(values, width):
            # Sub-solve: the cluster's own problem, shifted so that its spread is not lost
            # beside the eigenvalues; its vectors are made orthonormal first.
            q, _ = np.linalg.qr(x[:, g])
            mean = values[g].mean()
            t = q.T @ (a @ q - mean * q)
            x[:, g] = q @ np.linalg.eigh((t + t.T) / 2)[1]
        change = np.abs(e).max()
        if change < 1e-15 or (change < 1e-10 and change >= last / 2):
            break
        last = change
    x = x + x @ (np.eye(d) - x.T @ x) / 2
    values = np.einsum("ij,ij->j", x, a @ x)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    top = x[np.argmax(np.abs(x), axis=0), np.arange(d)]
    return values[order], x * np.where(top < 0, -1.0, 1.0)


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors) of a symmetric matrix: float32 solution, corrected in float64."""
    top = np.abs(a).max()
    if not top:
        return np.zeros(len(a)), np.eye(len(a))
    _, first = np.linalg.eigh((a / top).astype(np.float32))
    values, x = refine(a / top, first)
    return values * top, x


def fit(v: DataFrame, d: int) -> Fit | None:
    n, sums, a = covariance(v, d)
    if not n:
        return None
    values, x = eigenvectors(a)
    return Fit(n, sums, x, values, float(np.trace(a)))


def identity_error(v: DataFrame, d: int, model: Fit, k: int) -> float | None:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    p = model.scaled(k)
    defined = ~np.isnan(p[0])
    k = int(defined.sum())
    if not k:
        return None
    p = p[:, defined]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, any_ = np.zeros((k + 1, k + 1)), False
        for b in small(batches, ROWS):
            w = model.centred(integers(b, d))[1] @ p
            w = np.concatenate([w, np.ones((len(w), 1))], axis=1)  # the last row sums the columns
            m, any_ = m + w.T @ w, True
        if any_:
            yield _entries(m)

    m = _matrix(v.mapInArrow(products, "i int, j int, s double"), k + 1) / model.n
    mean = m[:k, k]  # zero but for rounding: rows are centred before they are multiplied
    return float(np.abs(m[:k, :k] - np.outer(mean, mean) - np.eye(k)).max())


def _deviation(y: np.ndarray) -> pa.Array:
    about = np.square(y.astype(np.float64)).sum(axis=1)
    if not len(about) or about.max() < 2.0**62:
        return pa.array(np.square(y).sum(axis=1), pa.int64())
    exact = [sum(int(c) ** 2 for c in row) for row in y]
    return pa.array([e if e < 2**63 else None for e in exact], pa.int64())


def whiten(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component (see SCHEMA)."""
    spark = vectors.sparkSession
    v, d = usable(vectors, column)
    model = fit(v, d) if d else None
    if model is None:
        return spark.createDataFrame([], SCHEMA)
    k = min(components, d)
    error = identity_error(v, d, model, k)
    p = model.scaled(k)
    explained = model.values[:k] / model.trace if model.trace > 0 else np.full(k, np.nan)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, ROWS):
            y, c = model.centred(integers(b, d))
            m = b.num_rows
            row = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(row), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)),
                _deviation(y).take(row), pa.array((c @ p).ravel(), from_pandas=True), pa.array(np.tile(explained, m), from_pandas=True),
                pa.array([error] * (m * k), pa.float64())], names=[x.split(" ")[0] for x in SCHEMA.split(", ")])

    return v.mapInArrow(project, SCHEMA)
