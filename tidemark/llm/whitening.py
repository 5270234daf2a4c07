"""Whitening of embeddings by incremental eigendecomposition.

1. Entries become integers, so that the sums over all vectors are exact.
2. Every partition goes over its vectors and keeps the eigendecomposition of their scatter
   about their own mean.  A further vector is a centred rank-one update: the new
   eigenvalues are the roots of a secular equation, the new eigenvectors come from a Cauchy matrix
   (``rank_one``).  Parts of the vector along no or equal eigenvalues are deflated first.
3. Two spectra are combined by rank-one updates too: one for the difference of the means
   and one for each eigenpair of the second.
4. Rayleigh-Ritz: the covariance of all vectors, projected on the combined basis in one more distributed pass,
   is solved exactly; what rounding the updates gathered is gone after it.

Scale: a task holds a few matrices of the dimension, never its vectors.  Partial results are
merged ``FAN`` at a time over rounds of tasks (``combined``), so neither one task nor the driver receives
all of them; the driver sees single matrices.  Equal vectors in a batch are one update with their number as weight.
Work is dealt by partitions, not by value, so no value is hot.

Defined cases: rows whose vector is null, empty, or holds a null or non-finite entry are left out, as are entries
beyond 2 ** 40, whose integers would not add up exactly; if lengths differ, the commonest counts (of equally common ones the
longest) and vectors of another are left out; repeated rows and repeated ids count and are returned
each; ties between eigenvalues leave the choice of vectors within their space; components without variance
(e below 1e-12 of the largest) have null ``whitened`` and take no part in the error; a deviation beyond a long is null;
an empty table has no rows; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import small_batches, written

FAN = 16
EPS = np.finfo(float).eps
FLAT = 1e-12            # share of the largest eigenvalue below which a component has no variance
REACH = 2.0 ** 40       # entries beyond are left out


def integers(vector: Column, scale: int = 64, offset: int = 1_000_000) -> Column:
    """floor(scale * entry) + offset of each entry as long."""
    return F.transform(vector, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long") + F.lit(offset))


def usable(vector: Column) -> Column:
    """Whether all entries are numbers in reach."""
    good = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) <= REACH, F.lit(False)))
    return vector.isNotNull() & (F.size(vector) > 0) & good


# ---------------------------------------------------------------- rank-one updates
def _roots(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum w_i / (d_i - x) for ascending d and positive w, and all d_i - root_j.

    Each root is sought as its distance from the nearer pole, by rational interpolation with the
    two poles beside it, inside a bracket that halves where that leaves it.
    """
    k = len(d)
    each = np.arange(k)
    right = np.append(d[1:], d[-1] + w.sum())
    half = (right - d) / 2
    at_half = 1 + (w[:, None] / (d[:, None] - (d + half)[None, :])).sum(0)
    from_left = at_half >= 0
    from_left[-1] = True
    origin = np.where(from_left, each, np.minimum(each + 1, k - 1))
    low, high = np.where(from_left, 0.0, -half), np.where(from_left, half, 0.0)
    high[-1] = 2 * half[-1]
    delta = d[:, None] - d[origin][None, :]
    before = each[:, None] <= each[None, :]
    beside = np.minimum(each + 1, k - 1)
    x = np.where(from_left, high, low) / 2
    x[-1] = high[-1] / 2
    with np.errstate(all="ignore"):
        for _ in range(60):
            gap = delta - x
            term = w[:, None] / gap
            slope = term / gap
            f = 1 + term.sum(0)
            high, low = np.where(f > 0, x, high), np.where(f > 0, low, x)
            done = (np.abs(f) <= 4 * k * EPS * (1 + np.abs(term).sum(0))) | (high - low <= 4 * EPS * np.abs(x))
            if done.all():
                break
            left_slope = np.where(before, slope, 0).sum(0)
            right_slope = slope.sum(0) - left_slope
            a, b = gap[each, each], gap[beside, each]
            q, s = left_slope * a * a, right_slope * b * b
            c = f - left_slope * a - right_slope * b
            m, p = c * (a + b) + q + s, a * b * f
            root = np.sqrt(np.maximum(m * m - 4 * p * c, 0))
            step = np.where(m <= 0, (m - root) / (2 * c), 2 * p / (m + root))
            step[-1] = a[-1] + q[-1] / (f[-1] - left_slope[-1] * a[-1])
            new = x + step
            new = np.where((new > low) & (new < high), new, (low + high) / 2)
            x = np.where(done, x, new)
        gap = delta - x
    return d[origin] + x, np.where(gap == 0, EPS * EPS, gap)


def rank_one(values: np.ndarray, basis: np.ndarray, weight: float, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and vectors of basis diag(values) basis' + weight vector vector'."""
    z = basis.T @ vector
    norm = float(z @ z)
    weight = weight * norm
    if not weight > 0:
        return values, basis
    z = z / np.sqrt(norm)
    tol = 8 * EPS * max(abs(values[0]), abs(values[-1]), weight)
    live = np.flatnonzero(weight * np.abs(z) > tol)
    if not len(live):
        return values, basis
    breaks = np.flatnonzero(np.diff(values[live]) > tol) + 1
    if len(breaks) + 1 < len(live):                      # equal values: one reflection leaves z with one part in their space
        basis, z, kept = basis.copy(), z.copy(), []
        for run in np.split(live, breaks):
            kept.append(run[0])
            if len(run) > 1:
                u = z[run].copy()
                size = np.sqrt(u @ u)
                u[0] += np.copysign(size, u[0])
                basis[:, run] -= np.outer(basis[:, run] @ u, u) * (2 / (u @ u))
                z[run[0]], z[run[1:]] = -np.copysign(size, u[0]), 0.0
        live = np.array(kept)
    d, part = values[live], z[live]
    roots, gap = _roots(d, weight * part * part)
    # the vector of which these are the exact roots keeps the new basis orthogonal
    apart = d[:, None] - d[None, :]
    np.fill_diagonal(apart, 1.0)
    exact = np.copysign(np.sqrt(np.abs(np.prod(gap / apart, axis=1))), part)
    turn = exact[:, None] / gap
    turn /= np.sqrt((turn * turn).sum(0))
    values, new = values.copy(), basis.copy()
    values[live], new[:, live] = roots, basis[:, live] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], new[:, order]


@dataclass
class Spectrum:
    """Number, mean, and eigendecomposition of the scatter about the mean."""

    n: float
    mean: np.ndarray
    values: np.ndarray
    basis: np.ndarray

    @staticmethod
    def empty(dim: int) -> Spectrum:
        return Spectrum(0.0, np.zeros(dim), np.zeros(dim), np.eye(dim))

    def add(self, vector: np.ndarray, count: float) -> None:
        off = vector - self.mean
        total = self.n + count
        self.values, self.basis = rank_one(self.values, self.basis, self.n * count / total, off)
        self.mean = self.mean + off * (count / total)
        self.n = total

    def parts(self) -> tuple:
        return self.n, self.mean, self.values, self.basis

    def merge(self, other: Spectrum) -> Spectrum:
        if not self.n or not other.n:
            return self if self.n else other
        total, off = self.n + other.n, other.mean - self.mean
        values, basis = rank_one(self.values, self.basis, self.n * other.n / total, off)
        for value, vector in zip(other.values, other.basis.T, strict=True):
            if value > 0:
                values, basis = rank_one(values, basis, float(value), vector)
        return Spectrum(total, self.mean + off * (other.n / total), values, basis)


# ---------------------------------------------------------------- partial results of partitions
def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def partial(rows: DataFrame, dim: int, start: Callable[[], object], add: Callable[[object, np.ndarray], object],
            pack: Callable[[object], object] = lambda state: state) -> DataFrame:
    """One pickled result for each partition that has rows: (k, result), k the partition's number."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, any_rows = start(), False
        for batch in batches:
            if len(batch):
                state, any_rows = add(state, _matrix(batch, dim)), True
        if any_rows:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()),
                                              pa.array([pickle.dumps(pack(state))], pa.binary())], names=["k", "result"])

    return rows.select("x").mapInArrow(work, "k long, result binary")


def combined(parts: DataFrame, label: str, merge: Callable[[object, object], object]):
    """All partial results merged, ``FAN`` at a time in order of their numbers; None without any."""
    parts = written(parts, label, narrow=True)
    most = parts.agg(F.max("k")).first()[0]
    if most is None:
        return None

    def group(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("k")
        out = pickle.loads(rows["result"].iloc[0])
        for x in rows["result"].iloc[1:]:
            out = merge(out, pickle.loads(x))
        return pd.DataFrame({"k": [rows["k"].iloc[0] // FAN], "result": [pickle.dumps(out)]})

    while most > 0:
        parts = parts.groupBy(F.floor(F.col("k") / FAN)).applyInPandas(group, "k long, result binary")
        most //= FAN
    return pickle.loads(parts.first()["result"])


def _sum(a, b):
    return a + b


@dataclass
class Whitening:
    """A fitted transform.  ``values`` fall; ``vectors`` are columns; ``sums`` are Python integers."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n with one rounding: whole part first, both exact."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole).astype(float) - rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n x - S) ** 2, exact; None beyond a long."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = [s % self.n for s in self.sums]
        off = x - whole
        bound = (float(np.abs(off).max(initial=0)) + 1) * self.n
        if bound * bound * max(1, x.shape[1]) < 2.0 ** 62:
            y = off * np.int64(self.n) - np.array(rest, np.int64)
            return (y * y).sum(1).tolist()
        exact = [sum((int(v) * self.n - r) ** 2 for v, r in zip(row, rest, strict=True)) for row in off.tolist()]
        return [v if v < 1 << 63 else None for v in exact]

    def shown(self, components: int) -> np.ndarray:
        """The columns that whiten: vectors over the roots of their values, nan where there is no variance."""
        k = min(components, len(self.values))
        flat = self.values[:k] <= FLAT * max(self.values[0], 0.0)
        scale = np.where(flat, np.nan, 1 / np.sqrt(np.where(flat, 1.0, self.values[:k])))
        return self.vectors[:, :k] * scale


def _spread(rows: DataFrame, n: int) -> DataFrame:
    """Rows over enough tasks for the updates, which cost far more than reading: at least a thousand rows a task."""
    want = min(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-n // 1024))
    return rows.repartition(want) if want > len(rows.inputFiles()) else rows


def fit(rows: DataFrame, dim: int) -> Whitening | None:
    """The whitening of ``rows`` (x: arrays of ``dim`` longs), a written table."""
    n_sums = combined(partial(rows, dim, lambda: np.zeros(dim + 1, object), lambda s, x: s + np.append(
        x.astype(object).sum(0) if np.abs(x).max() > 2 ** 40 else x.sum(0).astype(object), len(x))), "sums", _sum)
    if n_sums is None:
        return None
    n, sums = int(n_sums[-1]), [int(s) for s in n_sums[:-1]]
    model = Whitening(n, sums, np.zeros(dim), np.eye(dim), 0.0)

    def update(spectrum: Spectrum, x: np.ndarray) -> Spectrum:
        each, counts = np.unique(x, axis=0, return_counts=True)
        for vector, count in zip(model.centred(each), counts.tolist(), strict=True):
            spectrum.add(vector, float(count))
        return spectrum

    spectra = partial(_spread(rows, n), dim, lambda: Spectrum.empty(dim), update, Spectrum.parts)
    spectrum = combined(spectra, "spectra", lambda a, b: Spectrum(*a).merge(Spectrum(*b)).parts())
    basis = np.linalg.qr(Spectrum(*spectrum).basis)[0]

    def project(total: np.ndarray, x: np.ndarray) -> np.ndarray:
        y = model.centred(x) @ basis
        return total + y.T @ y

    ritz = combined(partial(rows, dim, lambda: np.zeros((dim, dim)), project), "ritz", _sum) / n
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    return Whitening(n, sums, values[::-1], (basis @ turn)[:, ::-1], float(np.trace(ritz)))


def identity_error(rows: DataFrame, dim: int, model: Whitening, components: int) -> float | None:
    """The largest absolute entry of the whitened vectors' covariance minus the identity; None if nothing varies."""
    by = model.shown(components)
    by = by[:, ~np.isnan(by[0])]
    if not by.shape[1]:
        return None

    def project(total: np.ndarray, x: np.ndarray) -> np.ndarray:
        y = model.centred(x) @ by
        return total + y.T @ y

    total = combined(partial(rows, dim, lambda: np.zeros((by.shape[1],) * 2), project), "identity", _sum)
    return float(np.abs(total / model.n - np.eye(by.shape[1])).max())


def whiten(vectors: DataFrame, components: int = 32, id_col: str = "vec_id", vector_col: str = "embedding",
           scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """One row for each usable vector and component: id, component, n, deviation, whitened, explained, identity_error."""
    schema = T.StructType([T.StructField("id", vectors.schema[id_col].dataType), T.StructField("component", T.IntegerType()),
                           T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
                           T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
                           T.StructField("identity_error", T.DoubleType())])
    vector = F.col(vector_col)
    rows = written(small_batches(vectors).where(usable(vector)).select(F.col(id_col).alias("id"), integers(vector, scale, offset).alias("x")),
                   "vectors")
    common = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if common is None:
        return rows.sparkSession.createDataFrame([], schema)
    dim = common["dim"]
    if rows.where(F.size("x") != dim).limit(1).count():
        rows = written(rows.where(F.size("x") == dim), "vectors")
    model = fit(rows, dim)
    error = identity_error(rows, dim, model, components)
    by = model.shown(components)
    k = by.shape[1]
    explained = model.values[:k] / model.trace if model.trace > 0 else np.full(k, np.nan)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch, dim)
            y = (model.centred(x) @ by).ravel()
            at = pa.array(np.repeat(np.arange(len(batch)), k))
            whitened, share = (pa.array(v, pa.float64(), from_pandas=True) for v in (y, np.tile(explained, len(batch))))
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(batch))),
                pa.array(np.full(len(batch) * k, model.n)), pa.array(model.deviations(x), pa.int64()).take(at),
                whitened, share, pa.array([error] * (len(batch) * k), pa.float64())], names=schema.names)

    return rows.mapInArrow(spread, schema)
