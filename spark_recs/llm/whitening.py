"""Embedding whitening through polarisation covariance.

Entries become integers (floor(1024 * c) + 100000).  For every dimension and
every sum of two dimensions the exact sum of squared centred values is
aggregated; with Var of each known, Cov(i, j) = (Var(i + j) - Var(i) - Var(j)) / 2,
so no cross product of two dimensions is ever summed.  The matrix, dimensions
times dimensions, goes to `eigh` on the driver.

Values are centred at the integer next to their mean (c = x - p) before they
are squared; with T = sum of c, the sum of squares about the mean itself is
sum of c*c - T*T/n, a fraction of whole numbers.  A task's sums are whole numbers
too (Python's where 64 bits could be too few), so nothing is rounded before the
matrix becomes doubles.

Three scans (sums; squares; the whitened rows' own covariance) and the one that
makes the rows.  A task sends one number per dimension or pair, whatever its rows.

Defined results: null vectors and vectors that hold null or non-finite entries
go; so do vectors shorter than the longest, whose missing entries count as
null; rows are rows, so equal ids are fitted and returned as often as they
occur, a null id too; a component without variance (constant or dependent
dimensions, a single row) is whitened 0, explains 0 and is left out of
identity_error; deviation is null where it needs over 64 bits; no rows, or
vectors without entries, give no rows; further columns are ignored.
"""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_recs.llm.store import materialize
from spark_recs.llm.topk import matrix, whole

COMPONENTS, SCALE, SHIFT = 8, 1024, 100_000
ROWS = 1024                    # rows squared at once
_SUMS = "dims int, place int, limb int, value decimal(38,0)"
_LIMB = 96                     # bits of a large sum that travel as one number
_WHITE = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _integers(x: np.ndarray) -> np.ndarray:
    """Whole doubles as integers: 64 bits where products of sums stay below 2**62, else Python's."""
    if np.abs(x).max(initial=0) < 2 ** 24:
        return x.astype(np.int64)
    return np.array([[int(v) for v in r] for r in x.tolist()], dtype=object).reshape(x.shape)


def _rows(b, dims: int | None = None):
    """(rows, x) of a batch: the longest vectors, or those of `dims` entries, `ROWS` at a time."""
    col = b.column(b.schema.get_field_index("vector"))
    size = np.diff(np.asarray(col.offsets).astype(np.int64))
    dims = int(size.max(initial=0)) if dims is None else dims
    keep = np.flatnonzero(size == dims)
    if len(keep) < len(size):
        b = b.take(pa.array(keep))
    for i in range(0, b.num_rows, ROWS):
        part = b.slice(i, ROWS)
        yield part, _integers(matrix(part.column(part.schema.get_field_index("vector")), SCALE, dims)) + SHIFT


def _numbers(dims: int, total) -> pa.RecordBatch:
    """A row per sum, or per `_LIMB` bits of one that needs more."""
    rows = []
    for place, t in enumerate(total):
        limb, t = 0, int(t)
        while abs(t) >> _LIMB:
            rows.append((place, limb, Decimal(t & ((1 << _LIMB) - 1))))
            limb, t = limb + 1, t >> _LIMB
        rows.append((place, limb, Decimal(t)))
    place, limb, value = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array([dims] * len(rows), pa.int32()), pa.array(place, pa.int32()), pa.array(limb, pa.int32()),
                                       pa.array(value, pa.decimal128(38, 0))], ["dims", "place", "limb", "value"])


def _added(rows: DataFrame) -> DataFrame:
    return rows.groupBy("dims", "place", "limb").agg(F.sum("value").cast("decimal(38,0)").alias("value"))


def _totals(added: DataFrame) -> list[int]:
    out: dict[int, int] = {}
    for place, limb, value in added.select("place", "limb", "value").collect():
        out[place] = out.get(place, 0) + (int(value) << (_LIMB * limb))
    return [out[i] for i in range(len(out))]


def _sum(batches):
    """Of the task's longest vectors: their number, then the sum of each dimension."""
    dims, total = 0, None
    for b in batches:
        for _, x in _rows(b):
            if x.shape[1] < dims or not x.shape[1]:
                continue
            if x.shape[1] > dims:
                dims, total = x.shape[1], np.zeros(x.shape[1] + 1, dtype=object)
            total += np.array([len(x), *x.sum(axis=0).tolist()], dtype=object)
    if total is not None:
        yield _numbers(dims, total)


def _squares(pivot: np.ndarray):
    """Sums of squares: of each dimension, then of each sum of two (i < j)."""
    dims = len(pivot)

    def run(batches):
        total = np.zeros(dims * (dims + 1) // 2, dtype=object)
        for b in batches:
            for _, x in _rows(b, dims):
                c = np.ascontiguousarray(_centred(x, pivot).T)
                parts = [(c * c).sum(axis=1)]
                for i in range(dims - 1):
                    z = c[i] + c[i + 1:]
                    z *= z
                    parts.append(z.sum(axis=1))
                total += np.concatenate(parts).astype(object)
        yield _numbers(dims, total)
    return run


def _centred(x: np.ndarray, pivot: np.ndarray) -> np.ndarray:
    return x - pivot if x.dtype == object or abs(pivot).max() >= 2 ** 62 else x - pivot.astype(np.int64)


def covariance(n: int, rest: list[int], squares: list[int]) -> np.ndarray:
    """From the polarised sums; `rest`: the sum of each dimension's centred values."""
    dims = len(rest)
    var = lambda sq, t: Fraction(n * sq - t * t, n * n)
    own = [var(s, t) for s, t in zip(squares, rest)]
    out, at = np.zeros((dims, dims)), dims
    for i in range(dims):
        out[i, i] = float(own[i])
        for j in range(i + 1, dims):
            out[i, j] = out[j, i] = float((var(squares[at], rest[i] + rest[j]) - own[i] - own[j]) / 2)
            at += 1
    return out


def components(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues, eigenvectors as columns, trace), by falling eigenvalue; the
    largest entry of each vector is positive; eigenvalues at rounding level are 0."""
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    e = np.where(e > len(e) * np.finfo(float).eps * max(e[0], 0), e, 0.0)
    u = u * np.where(u[np.abs(u).argmax(axis=0), np.arange(len(e))] < 0, -1.0, 1.0)
    return e[:k], u[:, :k], float(np.trace(v))


class Fit:
    """What the rows need: sums, eigenvalues and eigenvectors."""

    def __init__(self, n: int, sums: list[int], pivot: np.ndarray, v: np.ndarray, k: int):
        self.n, self.pivot = n, pivot
        self.sums = np.array(sums, dtype=object)
        self.shift = np.array([float(Fraction(s, n) - int(p)) for s, p in zip(sums, pivot)])
        self.e, self.u, self.trace = components(v, k)
        self.step = self.u / np.sqrt(np.where(self.e > 0, self.e, 1.0)) * (self.e > 0)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (_centred(x, self.pivot).astype(np.float64) - self.shift) @ self.step

    def deviation(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, whether they need over 64 bits)."""
        far = max(1, int(abs(_centred(x, self.pivot)).max(initial=0)) + 1) * self.n
        if far * far * x.shape[1] < 2 ** 62 and max(abs(int(s)) for s in self.sums) < 2 ** 62:
            d = self.n * _centred(x, self.pivot) - (self.sums - self.n * self.pivot).astype(np.int64)
            return (d * d).sum(axis=1), np.zeros(len(x), dtype=bool)
        d = self.n * x.astype(object) - self.sums
        s = (d * d).sum(axis=1)
        wide = np.array([v >= 2 ** 63 for v in s])
        return np.where(wide, 0, s).astype(np.int64), wide


def _moments(fit: Fit):
    """Sums of the whitened rows and of their products."""
    dims, k = len(fit.pivot), len(fit.e)

    def run(batches):
        total = np.zeros((k + 1, k))
        for b in batches:
            for _, x in _rows(b, dims):
                w = fit.whitened(x)
                total[0] += w.sum(axis=0)
                total[1:] += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], ["place", "value"])
    return run


def _white(fit: Fit, error: float):
    dims, k = len(fit.pivot), len(fit.e)
    explained = fit.e / fit.trace if fit.trace > 0 else fit.e

    def run(batches):
        for b in batches:
            for part, x in _rows(b, dims):
                deviation, wide = fit.deviation(x)
                m = len(x)
                yield pa.RecordBatch.from_arrays([
                    part.column(part.schema.get_field_index("vec_id")).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, fit.n)),
                    pa.array(np.repeat(deviation, k), mask=np.repeat(wide, k)), pa.array(fit.whitened(x).ravel()),
                    pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whiten(vectors: DataFrame, k: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """A row per vector and component up to `k` (see the module's text)."""
    spark = vectors.sparkSession
    src = vectors.filter(whole(vector)).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    # tasks with only shorter vectors report their own length; one row per length and place
    sums = materialize(_added(src.mapInArrow(_sum, _SUMS)), "sums")
    dims = sums.agg(F.max("dims")).first()[0]
    if not dims:
        return spark.createDataFrame([], _WHITE)
    n, *s = _totals(sums.filter(F.col("dims") == dims))
    pivot = np.array([(2 * v + n) // (2 * n) for v in s], dtype=object)
    squares = _totals(_added(src.mapInArrow(_squares(pivot), _SUMS)))
    v = covariance(n, [a - n * int(p) for a, p in zip(s, pivot)], squares)
    fit = Fit(n, s, pivot, v, k)
    got = dict(src.mapInArrow(_moments(fit), "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect())
    m = np.array([got[i] for i in range(len(got))]).reshape(-1, len(fit.e)) / n
    some = fit.e > 0
    error = np.abs(m[1:] - np.outer(m[0], m[0]) - np.eye(len(fit.e)))[np.ix_(some, some)]
    return src.mapInArrow(_white(fit, float(error.max(initial=0))), _WHITE)
