"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

Entries become integers, so equal vectors are equal exactly.  The fit list is
each distinct vector once.  Its sums are exact; its scatter is summed from
vectors that are centred first (the integer part of the mean is subtracted
exactly).  The scatter is a matrix of dimension times dimension numbers: only
it and the sums reach the driver, which factors it:

* Cholesky with diagonal pivoting gives a triangular factor of as many columns
  as the scatter has numerical rank;
* one-sided Jacobi turns pairs of that factor's columns until all are
  orthogonal.  Squared column norms are the eigenvalues (times n), and the
  normalised columns are the components.

Two further passes measure the whitened covariance of the fit list and write
every row's projections.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .book import query
from .common import cut, drop_cut, table
from .vectors import by_length, packed, pieces, unpacked

SCALE, COMPONENTS = 256, 4
#: Integers are kept within this bound; a vector beyond it has no exact form.
LARGEST = 1 << 62
SWEEPS = 60
#: Rows that are multiplied at a time.
ROWS = 4096


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """Factor l (rows in a's order, one column a pivot) with l @ l.T = a, for
    a positive semidefinite ``a``; ends at its numerical rank."""
    rest = a.astype(float).copy()
    d = len(rest)
    least = d * np.finfo(float).eps * max(rest.diagonal().max(initial=0.0), 0.0)
    out = np.zeros((d, d))
    open_ = np.ones(d, bool)
    for k in range(d):
        diagonal = np.where(open_, rest.diagonal(), -1.0)
        p = int(diagonal.argmax())
        if diagonal[p] <= least:
            return out[:, :k]
        column = np.where(open_, rest[:, p], 0.0) / np.sqrt(diagonal[p])
        out[:, k] = column
        rest -= np.outer(column, column)
        open_[p] = False
    return out


def _rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Round-robin: every pair of n columns once, disjoint pairs in a round."""
    m = n + n % 2
    ring = np.arange(m)
    out = []
    for _ in range(m - 1):
        a, b = ring[: m // 2], ring[m // 2 :][::-1]
        real = (a < n) & (b < n)
        out.append((np.minimum(a, b)[real], np.maximum(a, b)[real]))
        ring = np.concatenate([ring[:1], ring[-1:], ring[1:-1]])
    return out


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """The factor's columns, turned until they are orthogonal to working precision."""
    c = np.ascontiguousarray(factor.T)  # a row here is a column there
    tol = np.finfo(float).eps * np.sqrt(max(1, factor.shape[0]))
    rounds = _rounds(len(c))
    for _ in range(SWEEPS):
        most = 0.0
        for p, q in rounds:
            x, y = c[p], c[q]
            xx, yy, xy = (x * x).sum(1), (y * y).sum(1), (x * y).sum(1)
            size = np.sqrt(xx) * np.sqrt(yy)
            off = np.divide(np.abs(xy), size, out=np.zeros_like(size), where=size > 0)
            most = max(most, off.max(initial=0.0))
            turn = np.flatnonzero(off > tol)
            if not len(turn):
                continue
            zeta = (yy[turn] - xx[turn]) / (2 * xy[turn])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cos = 1 / np.hypot(1.0, t)
            sin = cos * t
            c[p[turn]] = cos[:, None] * x[turn] - sin[:, None] * y[turn]
            c[q[turn]] = sin[:, None] * x[turn] + cos[:, None] * y[turn]
        if most <= tol:
            break
    return c.T


def principal(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues by falling size, unit eigenvectors as columns) of a scatter
    matrix, as many as its numerical rank; each vector's largest entry is positive."""
    turned = one_sided_jacobi(pivoted_cholesky(scatter))
    norm = np.sqrt((turned * turned).sum(0))
    order = np.argsort(-norm, kind="stable")
    order = order[norm[order] > 0]
    vectors = turned[:, order] / norm[order]
    if vectors.size:
        vectors *= np.where(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    return norm[order] ** 2, vectors


@dataclass
class Whitening:
    """What the fit found: vectors of ``dim`` integers, n of them distinct."""

    dim: int
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole = np.array([s // self.n for s in self.sums], np.int64)
        part = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole).astype(float) - part

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sums of (n*x - S)^2, exactly."""
        reach = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums))
        if reach < 1 << 31 and reach * reach * self.dim < LARGEST:
            y = self.n * x - np.array(self.sums, np.int64)
            return (y * y).sum(1).tolist()
        if reach * reach < LARGEST:  # squares fit, their sums need not
            y = self.n * x - np.array(self.sums, np.int64)
            y = y * y
            return [(h << 32) + low for h, low in zip((y >> 32).sum(1).tolist(), (y & 0xFFFFFFFF).sum(1).tolist())]
        y = self.n * x.astype(object) - np.array(self.sums, object)
        return (y * y).sum(1).tolist()


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, x): each usable vector's floor(scale * entry) as packed 64-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "embedding"):
            for rows, m in by_length(b.column("embedding")):
                with np.errstate(over="ignore"):
                    y = np.floor(m * scale)
                good = (np.isfinite(m) & (np.abs(y) < LARGEST)).all(1)
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id").take(pa.array(rows[good])), pa.array(packed(y[good].astype(np.int64)), pa.binary())],
                    ["vec_id", "x"])

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(run, "vec_id long, x binary")


def _sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dim, object)
        for b in batches:
            x = unpacked(b.column("x"), np.int64, dim)
            n += len(x)
            for i in range(0, len(x), ROWS):
                part = x[i : i + ROWS]
                small = int(np.abs(part).max(initial=0)) < LARGEST // ROWS
                total = total + (part.sum(0).astype(object) if small else part.astype(object).sum(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dim), pa.int32()), pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0)),
             pa.array([n] * dim, pa.int64())], ["i", "s", "n"])

    rows = fit.mapInArrow(run, "i int, s decimal(38,0), n long").groupBy("i").agg(
        F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
    sums = [0] * dim
    for r in rows:
        sums[r["i"]] = int(r["s"])
    return (rows[0]["n"] if rows else 0), sums


def _gram(fit: DataFrame, dim: int, width: int, of) -> np.ndarray:
    """Sum of y'y over the fit list for the ``width`` columns y = of(x)."""
    upper = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for b in batches:
            x = unpacked(b.column("x"), np.int64, dim)
            for i in range(0, len(x), ROWS):
                y = of(x[i : i + ROWS])
                total += y.T @ y
        yield pa.RecordBatch.from_arrays(
            [pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), pa.array(total[upper])],
            ["i", "j", "s"])

    out = np.zeros((width, width))
    for r in fit.mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["s"]
    return out


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The fit over the distinct vectors of ``integers``; None without rows.
    Its vectors have one length: the most frequent one (of equals the longest)."""
    lengths = rows.groupBy(F.length("x").alias("bytes")).count().orderBy(F.desc("count"), F.desc("bytes")).first()
    if lengths is None:
        return None
    dim = lengths["bytes"] // 8
    fit = cut(rows.where(F.length("x") == 8 * dim).select("x").distinct())
    n, sums = _sums(fit, dim)
    found = Whitening(dim, n, sums, np.zeros(0), np.zeros((dim, 0)), 0.0)
    scatter = _gram(fit, dim, dim, found.centred)
    values, vectors = principal(scatter)
    found.trace = float(scatter.trace()) / n
    found.values, found.vectors = values[:components] / n, vectors[:, :components]
    k = len(found.values)
    if k:
        found.identity_error = float(np.abs(_gram(fit, dim, k, found.project) / n - np.eye(k)).max())
    drop_cut(fit)
    return found


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """One row per usable vector and component (numbered from 1 by falling
    variance): vec_id, component, n (distinct vectors of the fit), deviation
    (sum of (n*x - S)^2; null where it does not fit 64 bits), deviation_exact
    (the same as decimal digits, always), whitened, explained and
    identity_error (one value).

    Rows are left out whose vector is null, empty, of another length than most,
    or holds a null or non-finite entry, or one whose integer passes 62 bits.
    There are as many components as the fit's numerical rank, ``components`` at
    most; without variance (one distinct vector) and for an empty table there
    are no rows.  Repeated rows each give their rows; a null vec_id stays null.
    Only vec_id and embedding are read, so other columns cannot clash."""
    schema = ("vec_id long, component int, n long, deviation long, deviation_exact string, whitened double, "
              "explained double, identity_error double")
    rows = cut(integers(vectors, scale))
    found = fit_whitening(rows, components)
    if found is None or not len(found.values):
        return vectors.sparkSession.createDataFrame([], schema)
    k, share = len(found.values), found.values / found.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                x = unpacked(part.column("x"), np.int64, found.dim)
                exact = found.deviations(x)
                fits = pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())
                each, m = pa.array(np.repeat(np.arange(len(x)), k)), len(x)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, found.n)), fits.take(each), pa.array(list(map(str, exact))).take(each),
                     pa.array(found.project(x).reshape(-1)), pa.array(np.tile(share, m)),
                     pa.array(np.full(m * k, found.identity_error))], [f.split()[0] for f in schema.split(", ")])

    return rows.where(F.length("x") == 8 * found.dim).mapInArrow(run, schema)


@query("op12_cholesky_jacobi")
def op12(spark, sf_dir):
    """Whitened first four components of all embeddings."""
    return whiten(table(spark, sf_dir, "embeddings"))
