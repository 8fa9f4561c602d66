"""Whitening of embeddings by an incremental eigendecomposition of their covariance.

Every task keeps the eigenvalues and eigenvectors of the scatter of the vectors it has met and
takes each further vector in as a centred rank-one update: the new eigenvalues are the roots of
a secular equation, found between their poles; directions that a vector does not touch, or whose
eigenvalues coincide, are deflated first. The spectra of tasks are combined eight at a time, each
by one rank-one update per eigenvector and one for the distance of the means. A last pass over
all vectors projects them on the basis found and diagonalises what comes out (Rayleigh-Ritz), so
rounding of the updates does not stay in the result.

Vectors are scaled to whole numbers, so sums and distances from the mean are exact. The basis of
``d * d`` doubles is all that a task, a merge or the driver holds; nothing grows with the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.shared import col, tasks, written

SCALE = 256
COMPONENTS = 4
FLAT = 1e-12  # an eigenvalue below this share of the trace counts as none
FAN_IN = 8  # spectra combined in one merge
MAX_ROUNDS = 60  # of the root finder, which takes about six
EPS = float(np.finfo(float).eps)

STATE = "n long, sums array<long>, spectrum array<double>, basis array<double>"
REPORT = T.StructType([
    T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
    T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
    T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType()),
])


def secular_roots(poles: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum(z2 / (poles - x)) = 0`` for rising poles, one above each.

    Returns, for each root, its distance from the nearer pole and the matrix of pole minus root
    (rows are poles), both without cancellation.
    """
    k = len(poles)
    total = z2.sum()
    above = np.append(poles[1:], poles[-1] + total)
    half = (above - poles) / 2
    left = np.arange(k)
    if k > 1:
        middle = poles[:-1] + half[:-1]
        value = 1 + (z2[:, None] / (poles[:, None] - middle)).sum(axis=0)
        right = np.append(value < 0, False)
    else:
        right = np.zeros(1, bool)
    origin = np.where(right, left + 1, left)
    low = np.where(right, -half, 0.0)
    high = np.where(right, 0.0, half)
    high[-1] = total
    shift = poles[:, None] - poles[origin]
    below = (left[:, None] <= left).astype(float)  # poles up to the one left of each root
    gap_low = shift[left, left]
    gap_high = np.append(shift[left[1:], left[:-1]], np.inf)
    last = np.arange(k) == k - 1
    x = (low + high) / 2
    x[-1] = min(max(z2[-1], total * EPS), total)
    for _ in range(MAX_ROUNDS):
        away = shift - x
        part = z2[:, None] / away
        slope = part / away
        value = 1 + part.sum(axis=0)
        psi, dpsi = np.einsum("ij,ij->j", part, below), np.einsum("ij,ij->j", slope, below)
        phi, dphi = value - 1 - psi, slope.sum(axis=0) - dpsi
        low, high = np.where(value < 0, x, low), np.where(value < 0, high, x)
        # one pole on each side stands for all poles of that side
        a, b = gap_low - x, np.where(last, 1.0, gap_high - x)
        q, s = dpsi * a * a, dphi * b * b
        c = 1 + psi - dpsi * a + phi - dphi * b
        t, w = c * (a + b) + q + s, value * a * b
        root = np.sqrt(np.maximum(t * t - 4 * c * w, 0))
        step = np.where(t <= 0, (t - root) / (2 * c), 2 * w / (t + root))
        step[-1] = a[-1] + q[-1] / (1 + psi[-1] - dpsi[-1] * a[-1])
        after = x + step
        wrong = ~((after > low) & (after < high)) & (step != 0)
        after = np.where(wrong, (low + high) / 2, after)
        done = np.abs(value) <= 8 * EPS * (1 - psi + phi)
        after = np.where(done, x, after)
        still = np.abs(after - x) > 4 * EPS * np.abs(after)
        x = after
        if not still.any():
            break
    return poles[origin] + x, shift - x


def rank_one(values: np.ndarray, basis: np.ndarray, vector: np.ndarray, weight: float):
    """Eigenvalues (rising) and eigenvectors after ``weight * vector vector^T`` is added."""
    z = basis.T @ vector * np.sqrt(weight)
    size = z @ z
    if not size:
        return values, basis
    small = 8 * EPS * max(values[-1], size)
    active = np.flatnonzero(np.abs(z) * np.sqrt(size) > small)
    equal = np.diff(values[active]) <= small
    if equal.any():
        basis = basis.copy()
        runs = np.split(active, np.flatnonzero(~equal) + 1)
        keep = []
        for run in runs:
            keep.append(run[-1])
            if len(run) == 1:
                continue
            # a reflection leaves the run's whole weight in its last direction
            mirror = z[run].copy()
            length = np.linalg.norm(mirror)
            length = -length if mirror[-1] > 0 else length
            mirror[-1] -= length
            mirror /= np.linalg.norm(mirror)
            basis[:, run] -= 2 * np.outer(basis[:, run] @ mirror, mirror)
            z[run] = 0
            z[run[-1]] = length
        active = np.array(keep)
    poles = values[active]
    with np.errstate(all="ignore"):  # a root next to its pole; such steps are bisected
        roots, away = secular_roots(poles, z[active] ** 2)
    # the weights for which these roots are exact, which keeps the vectors orthogonal
    apart = poles - poles[:, None]
    np.fill_diagonal(apart, 1.0)
    exact = np.sqrt(np.abs(np.prod(-away / apart, axis=1)))
    turn = np.copysign(exact, z[active])[:, None] / away
    turn /= np.linalg.norm(turn, axis=0)
    values, made = values.copy(), basis.copy()
    values[active] = roots
    made[:, active] = basis[:, active] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], made[:, order]


@dataclass
class Spectrum:
    """Number, sums, eigenvalues (rising) and eigenvectors (columns) of the scatter of vectors."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    basis: np.ndarray

    @classmethod
    def empty(cls, size: int) -> "Spectrum":
        return cls(0, np.zeros(size, np.int64), np.zeros(size), np.eye(size))

    def take(self, vector: np.ndarray) -> None:
        """One vector more."""
        if self.n:
            apart = vector - self.sums / self.n
            weight = self.n / (self.n + 1)
            self.values, self.basis = rank_one(self.values, self.basis, apart, weight)
        self.n += 1
        self.sums = self.sums + vector

    def join(self, other: "Spectrum") -> None:
        """All vectors of another spectrum."""
        if self.n and other.n:
            apart = self.sums / self.n - other.sums / other.n
            weight = self.n * other.n / (self.n + other.n)
            self.values, self.basis = rank_one(self.values, self.basis, apart, weight)
        for value, vector in zip(other.values, other.basis.T):
            if value > 0:
                self.values, self.basis = rank_one(self.values, self.basis, vector, value)
        self.n += other.n
        self.sums = self.sums + other.sums

    def row(self) -> dict:
        return {"n": self.n, "sums": self.sums, "spectrum": self.values, "basis": self.basis.ravel()}

    @classmethod
    def of(cls, row) -> "Spectrum":
        size = len(row["sums"])
        basis = np.array(row["basis"], float).reshape(size, size)
        return cls(int(row["n"]), np.array(row["sums"], np.int64), np.array(row["spectrum"], float), basis)


def usable(vector: Column) -> Column:
    """A vector that is not null and whose entries are all finite numbers."""
    finite = F.forall(
        vector, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < F.lit(float("inf")))
    )
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def whole(vector: Column) -> Column:
    return F.transform(vector, lambda e: F.floor(e.cast("double") * SCALE).cast("long") + F.lit(0).cast("long"))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def spectrum(vectors: DataFrame, size: int) -> Spectrum:
    """The spectrum of the whole-number vectors in column ``x``, all of one size."""

    def local(batches):
        state = Spectrum.empty(size)
        for batch in batches:
            for vector in _matrix(batch.column(0), size):
                state.take(vector)
        if state.n:
            row = state.row()
            yield pa.RecordBatch.from_arrays([pa.array([row[c]]) for c in row], names=list(row))

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        state = Spectrum.of(rows.iloc[0])
        for i in range(1, len(rows)):
            state.join(Spectrum.of(rows.iloc[i]))
        return pd.DataFrame([{"part": rows["part"].iloc[0] // FAN_IN, **state.row()}])

    states = vectors.select("x").mapInArrow(local, STATE)
    states = written(states.withColumn("part", F.spark_partition_id().cast("long")), "spectra")
    while states.count() > 1:
        merged = states.groupBy(F.floor(F.col("part") / FAN_IN)).applyInPandas(merge, f"part long, {STATE}")
        states = written(merged, "spectra")
    return Spectrum.of(states.first())


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Exactly ``n * x - sums``."""
    if len(x) and (int(np.abs(x).max()) + 1) * n >= 1 << 62:
        raise OverflowError("embeddings too large for exact sums in 64 bits")
    return x * n - sums


def _pair_sums(vectors: DataFrame, project, width: int) -> np.ndarray:
    """Sum of the outer products of all projected vectors with themselves, added up by Spark."""
    rows, columns = np.triu_indices(width)

    def local(batches):
        total = np.zeros((width, width))
        for batch in batches:
            y = project(batch.column(0))
            total += y.T @ y
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows), pa.array(columns), pa.array(total[rows, columns])], names=["i", "j", "v"]
        )

    sums = vectors.select("x").mapInArrow(local, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    found = sums.toArrow()
    i, j, v = (found.column(c).to_numpy() for c in ("i", "j", "v"))
    out = np.zeros((width, width))
    out[i, j] = out[j, i] = v
    return out


@dataclass
class Whitening:
    """What whitening needs: number and sums of the fit list, components (columns, by falling
    eigenvalue) with their eigenvalues and shares of the trace."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of whole-number vectors; 0 along a flat component."""
        y = _centred(x, self.n, self.sums) / self.n @ self.components
        flat = self.explained <= FLAT
        return np.where(flat, 0.0, y / np.sqrt(np.where(flat, 1.0, self.values)))


def fit(vectors: DataFrame, size: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of the distinct whole-number vectors in column ``x``."""
    found = spectrum(vectors, size)
    basis, _ = np.linalg.qr(found.basis)
    n, sums = found.n, found.sums

    def on_basis(column):
        return _centred(_matrix(column, size), n, sums) / n @ basis

    values, turn = np.linalg.eigh(_pair_sums(vectors, on_basis, size) / n)
    values, turn = np.maximum(values[::-1], 0), turn[:, ::-1]
    trace = values.sum()
    keep = min(components, size)
    share = values[:keep] / trace if trace else np.zeros(keep)
    return Whitening(n, sums, (basis @ turn)[:, :keep], values[:keep], share)


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest distance of the whitened fit list's covariance from the identity."""
    size = len(model.sums)

    def padded(column):
        y = model.apply(_matrix(column, size))
        return np.column_stack([y, np.ones(len(y))])

    sums = _pair_sums(vectors, padded, len(model.values) + 1) / model.n
    real = model.explained > FLAT
    off = sums[:-1, :-1] - np.outer(sums[-1, :-1], sums[-1, :-1]) - np.eye(len(real))
    off = off[real][:, real]
    return float(np.abs(off).max()) if off.size else 0.0


def whitening_report(
    table: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per usable vector and component: the key, ``component``, ``n``, ``deviation``,
    ``whitened``, ``explained``, ``identity_error``.

    Rows whose vector is null or holds a null or non-finite entry are dropped. If vectors differ
    in size, those of the most frequent size (the largest of several) stay. Repeated rows each
    give their rows but count once in the fit; a null key stays null. A component without
    variance has ``whitened`` and ``explained`` 0. No usable vector, or only vectors without an
    entry, give no rows. Other columns are ignored, whatever their names. A vector whose
    ``deviation`` does not fit a long has null there; entries that do not leave room for exact
    sums raise an error.
    """
    rows = table.select(col(key).alias("key"), col(vector).alias("v")).where(usable(F.col("v")))
    rows = rows.select("key", whole(F.col("v")).alias("x"))
    sizes = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size"))
    usual = sizes.limit(1).collect()
    schema = T.StructType([T.StructField(key, rows.schema["key"].dataType), *REPORT.fields])
    if not usual or not usual[0]["size"]:
        return table.sparkSession.createDataFrame([], schema)
    size = usual[0]["size"]
    rows = rows.where(F.size("x") == size)
    # few bytes but much work a row: as many tasks as the session has, however small the table
    distinct = written(rows.select("x").distinct().repartition(tasks(rows)), "fit-list")
    model = fit(distinct, size, components)
    error = identity_error(distinct, model)
    kept = len(model.values)

    def report(batches):
        for batch in batches:
            x = _matrix(batch.column(1), size)
            apart = _centred(x, model.n, model.sums)
            large = float(np.abs(apart).max(initial=0)) ** 2 * size >= 2.0**62
            deviation = (
                pa.array([d if (d := sum(int(a) ** 2 for a in row)) < 1 << 63 else None for row in apart], pa.int64())
                if large else pa.array((apart * apart).sum(axis=1))
            )
            n = len(x)
            at = pa.array(np.repeat(np.arange(n), kept))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(at), pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), n)),
                pa.array(np.full(n * kept, model.n)), deviation.take(at), pa.array(model.apply(x).ravel()),
                pa.array(np.tile(model.explained, n)), pa.array(np.full(n * kept, error)),
            ], names=schema.names)

    return rows.mapInArrow(report, schema)
