"""Whitening of embeddings by an incremental eigendecomposition.

Entries become integers floor(256 c); the fit list is every distinct integer vector once. Each task keeps the
spectrum (count, mean, eigenvalues and eigenvectors of the scatter matrix about the mean) of the vectors it has
seen. A further vector, centred at the mean before it, is a rank-one change: its part outside the eigenvectors'
span adds one direction, then the roots of the secular equation 1 + sum z_j^2 / (d_j - t) = 0 are the new
eigenvalues. Entries whose z vanishes are deflated, and so are equal eigenvalues, after a reflection that turns
their z into one entry. Roots are kept as distances from the nearest old eigenvalue, and z is recomputed from the
roots, so that the vectors stay orthogonal. Spectra are merged in a tree: every eigenpair of one is a rank-one
change of the other, and the difference of the means is one more. At last the whole covariance, centred at the
exact mean, is projected on the merged eigenvectors in one pass over the fit list (Rayleigh-Ritz), which leaves
errors of double precision; tasks send one matrix of the size of the dimension, merged in the same tree.

Rows whose vector is null, empty or holds null or non-finite entries are dropped. So are vectors of another length
than the most frequent one (of equally frequent ones the shorter). Entries beyond a long are the nearest
long. Repeated rows give repeated results and weigh once in the fit. Components with no variance (an eigenvalue
within rounding of zero) can't be whitened and have no rows: a table of equal vectors, like an empty one, gives
none. Where eigenvalues are equal any orthonormal basis of their space is right. A deviation beyond a long is null.
Other columns do not matter, whatever their names.

Only the count, the sums, and matrices of the size of the dimension reach the driver.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.llm.common import col
from tablewarden.session import materialize

SCALE = 256
ROWS_PER_TASK = 2048
FAN_IN = 8
EPS = np.finfo(float).eps
LONG = 2**63


def secular(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots t of 1 + sum z2_j / (d_j - t) for rising d and positive z2, and the matrix d_j - t_i.

    Each root is found as a distance from the nearer of the two poles around it, by interpolation with both
    poles (the middle way of Li, 1993), kept inside a bracket.
    """
    k = len(d)
    upper = np.append(d[1:], d[-1] + z2.sum())
    width = upper - d
    left = np.arange(k)
    middle = (d[:, None] - d[None, :]) - width / 2
    nearer_right = (1 + (z2[:, None] / middle).sum(0) < 0) & (left < k - 1)
    origin = left + nearer_right
    delta = d[:, None] - d[origin][None, :]
    low = np.where(nearer_right, -width / 2, 0.0)
    high = np.where(nearer_right, 0.0, width / 2)
    high[-1] = width[-1]
    t = (low + high) / 2
    below = (np.arange(k)[:, None] <= left[None, :]).astype(float)
    right = np.minimum(left + 1, k - 1)
    with np.errstate(all="ignore"):
        for _ in range(80):
            gap = delta - t
            inverse = 1 / gap
            part = inverse * below
            whole, lower = z2 @ inverse, z2 @ part  # terms of poles below a root are negative
            f = 1 + whole
            done = np.abs(f) <= 4 * EPS * k * (1 + whole - 2 * lower)
            low, high = np.where(f < 0, t, low), np.where(f > 0, t, high)
            if (done | (high - low <= EPS * np.maximum(np.abs(low), np.abs(high)))).all():
                break
            psi, slope = z2 @ (part * inverse), z2 @ (inverse * inverse)
            g0, g1 = gap[left, left], gap[right, left]
            c = f - g0 * psi - g1 * (slope - psi)
            a = (g0 + g1) * f - g0 * g1 * slope
            b = g0 * g1 * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step[-1] = g0[-1] + psi[-1] * g0[-1] ** 2 / c[-1]  # one pole only
            new = t + step
            inside = (new > low) & (new < high)
            t = np.where(done, t, np.where(inside, new, (low + high) / 2))
    return d[origin] + t, delta - t


def _sharpened(d: np.ndarray, z: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """The z for which the computed roots are exact (Gu and Eisenstat, 1994)."""
    apart = d[None, :] - d[:, None]
    np.fill_diagonal(apart, 1.0)
    return np.copysign(np.sqrt(np.abs(np.prod(gap / apart, axis=1))), z)


def rank_one(values: np.ndarray, vectors: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of V diag(values) V' + x x'; ``vectors`` may span a part of the space only."""
    z = vectors.T @ x
    rest = x - vectors @ z
    z_more = vectors.T @ rest
    rest -= vectors @ z_more
    z = z + z_more
    size, whole = np.linalg.norm(rest), np.linalg.norm(x)
    if whole == 0:
        return values, vectors
    if len(values) < len(x) and size > 8 * len(x) * EPS * whole:
        values, z = np.append(values, 0.0), np.append(z, size)
        vectors = np.column_stack([vectors, rest / size])
    order = np.argsort(values, kind="stable")
    d, z, vectors = values[order], z[order], vectors[:, order]
    least = 8 * EPS * (max(abs(d[-1]), abs(d[0])) + whole * whole)
    # Equal values: one reflection of their vectors gathers their z in the last of them.
    first = 0
    while (np.diff(d[first:]) <= least).any():
        first += int(np.argmax(np.diff(d[first:]) <= least))
        last = int(np.searchsorted(d, d[first] + least, side="right"))
        if np.abs(z[first : last - 1]).max() > 0:
            v, norm = z[first:last].copy(), np.linalg.norm(z[first:last])
            sign = -1.0 if v[-1] >= 0 else 1.0
            v[-1] -= sign * norm
            v /= np.linalg.norm(v)
            vectors[:, first:last] -= 2 * np.outer(vectors[:, first:last] @ v, v)
            z[first:last] = 0
            z[last - 1] = sign * norm
        first = last
    active = np.abs(z) * whole > least
    if not active.any():
        return d, vectors
    roots, gap = secular(d[active], z[active] ** 2)
    turned = _sharpened(d[active], z[active], gap)[:, None] / gap
    turned /= np.linalg.norm(turned, axis=0)
    d, vectors = d.copy(), vectors.copy()
    d[active], vectors[:, active] = roots, vectors[:, active] @ turned
    return d, vectors


@dataclass
class Spectrum:
    """Vectors seen so far: their count, exact sums, and the eigenpairs of their scatter about the mean."""

    n: int
    sums: np.ndarray  # Python integers
    values: np.ndarray
    vectors: np.ndarray
    mean: np.ndarray = field(init=False)

    def __post_init__(self):
        self.mean = (self.sums / max(self.n, 1)).astype(float)

    @classmethod
    def empty(cls, d: int) -> Spectrum:
        return cls(0, np.array([0] * d, dtype=object), np.zeros(0), np.zeros((d, 0)))

    def add(self, rows: np.ndarray) -> None:
        """One centred rank-one update per row of integers."""
        for row in rows.astype(float):
            away = row - self.mean
            self.values, self.vectors = rank_one(self.values, self.vectors, away * np.sqrt(self.n / (self.n + 1)))
            self.n += 1
            self.mean = self.mean + away / self.n
        self.sums = self.sums + rows.astype(object).sum(axis=0)

    def merge(self, other: Spectrum) -> None:
        """The other's eigenpairs as rank-one updates, then the one for the means."""
        if not other.n:
            return
        self.mean, theirs = (self.sums / max(self.n, 1)).astype(float), (other.sums / other.n).astype(float)
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, np.sqrt(value) * vector)
        between = np.sqrt(self.n * other.n / (self.n + other.n))
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, between * (theirs - self.mean))
        self.n, self.sums = self.n + other.n, self.sums + other.sums
        self.mean = (self.sums / self.n).astype(float)


def integers(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x): rows that can be used, as integer vectors of one length."""
    v = col(vector)
    sound = ~F.exists(v, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    rows = df.where(v.isNotNull() & (F.size(v) > 0)).where(sound).select(
        col(key).alias("vec_id"), F.transform(v, lambda c: F.floor(c.cast("double") * SCALE)).alias("x"))
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("x") == (common["d"] if common else 0))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The x of a batch as rows of 64-bit integers."""
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _gathered(df: DataFrame, start: Callable, add: Callable, merge: Callable, tasks: int):
    """``add`` batches to a state per task, then ``merge`` states in a tree of FAN_IN; the one state, or None.

    Every state has a size that does not depend on the number of rows.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                state = add(start(x.shape[1]) if state is None else state, x)
        if state is not None:
            yield pa.RecordBatch.from_pydict({"node": [TaskContext.get().partitionId()], "state": [pickle.dumps(state)]})

    def together(group: pd.DataFrame) -> pd.DataFrame:
        states = [pickle.loads(s) for s in group.sort_values("node").state]
        for other in states[1:]:
            states[0] = merge(states[0], other)
        return pd.DataFrame({"node": [int(group.node.iloc[0]) // FAN_IN], "state": [pickle.dumps(states[0])]})

    states = df.mapInArrow(scan, "node long, state binary")
    while tasks > 1:
        states = states.groupBy(F.expr(f"node div {FAN_IN}")).applyInPandas(together, "node long, state binary")
        tasks = -(-tasks // FAN_IN)
    found = states.collect()
    return pickle.loads(found[0]["state"]) if found else None


def _complete(vectors: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the whole space that begins with ``vectors``."""
    q, _ = np.linalg.qr(np.column_stack([vectors, np.eye(len(vectors))]))
    return q


@dataclass(frozen=True)
class Whitening:
    """What is learnt from a fit list."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray  # all eigenvalues of the covariance, falling
    vectors: np.ndarray  # one column per component that can be whitened
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def explained(self) -> np.ndarray:
        return self.values[: self.vectors.shape[1]] / self.values.sum()

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x.astype(float) - self.mean) @ self.vectors / np.sqrt(self.values[: self.vectors.shape[1]])

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n x - S)^2, exact."""
        most = self.n * max(-int(x.min()), int(x.max()), 0) + max(map(abs, self.sums))
        if len(self.sums) * most**2 < LONG:
            return pa.array(((self.n * x - np.array(self.sums, dtype=np.int64)) ** 2).sum(axis=1))
        exact = ((self.n * x.astype(object) - np.array(self.sums, dtype=object)) ** 2).sum(axis=1)
        return pa.array([int(v) if v < LONG else None for v in exact], pa.int64())


def fit(rows: DataFrame, components: int = 4) -> Whitening | None:
    """Learn from the distinct x of ``rows``; None if there are none or they do not vary."""
    distinct = materialize(rows.select("x").distinct(), "fit-list")
    tasks = max(1, -(-distinct.count() // ROWS_PER_TASK))
    spread = distinct.repartition(tasks, "x")

    def add_rows(state: Spectrum, x: np.ndarray) -> Spectrum:
        state.add(x)
        return state

    def merge_spectra(state: Spectrum, other: Spectrum) -> Spectrum:
        state.merge(other)
        return state

    spectrum = _gathered(spread, Spectrum.empty, add_rows, merge_spectra, tasks)
    if spectrum is None:
        return None
    n, mean, basis = spectrum.n, (spectrum.sums / spectrum.n).astype(float), _complete(spectrum.vectors)

    def scatter(state, x: np.ndarray):
        y = (x.astype(float) - mean) @ basis
        return state + y.T @ y

    scan_tasks = max(1, tasks // 8)
    scanned = distinct.repartition(scan_tasks, "x")
    ritz, turn = np.linalg.eigh(_gathered(scanned, lambda d: np.zeros((d, d)), scatter, np.add, scan_tasks) / n)
    values, vectors = ritz[::-1], (basis @ turn)[:, ::-1]
    usable = int((values[:components] > 8 * len(values) * EPS * values.sum()).sum()) if values.sum() > 0 else 0
    if not usable:
        return None
    vectors = vectors[:, :usable]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(usable)])
    model = Whitening(n, tuple(int(s) for s in spectrum.sums), values, vectors, float("nan"))

    def spread_of(state, x: np.ndarray):
        y = model.project(x)
        return state + y.T @ y

    covariance = _gathered(scanned, lambda d: np.zeros((usable, usable)), spread_of, np.add, scan_tasks) / n
    return Whitening(n, model.sums, values, vectors, float(np.abs(covariance - np.eye(usable)).max()))


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 4) -> DataFrame:
    """Per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = integers(df, key, vector)
    model = fit(rows, components)
    schema = T.StructType([
        rows.schema["vec_id"], T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType()),
    ])
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    k = model.vectors.shape[1]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch)
            again = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(again), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(x) * k, model.n)), model.deviations(x).take(again), pa.array(model.project(x).ravel()),
                pa.array(np.tile(model.explained, len(x))), pa.array(np.full(len(x) * k, model.identity_error)),
            ], names=schema.names)

    return rows.mapInArrow(project, schema)
