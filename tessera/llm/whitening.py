"""Embedding whitening by incremental eigendecomposition.

Each task keeps the mean and the spectrum (eigenvalues and eigenvectors of the scatter) of
the vectors it has seen. A new vector changes the scatter by one centred rank-one term, so
the new eigenvalues are the roots of a secular equation between the old ones: directions
without a share in the vector, and all but one of equal eigenvalues, are deflated, the other
roots are found together by a rational interpolation, and the eigenvectors follow from the
roots. Spectra of two tasks are combined by the same update, once per eigenvector of the
second and once for the distance of the means, in a tree of small groups. The combined
vectors are the basis of one last Rayleigh-Ritz step, in which all tasks sum the covariance
of the centred vectors in that basis; its small eigenproblem gives the components to double
precision whatever the rounding of the updates.

Vectors are quantised to integers, so counts, sums and squared deviations are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import read, stage

SCALE = 256
#: Spectra or matrices that one group of the tree combines.
FAN_IN = 8
EPS = np.finfo(float).eps
LONG_MAX = 2 ** 63 - 1
#: Entries of the vectors that a task turns into one matrix.
MATRIX_ENTRIES = 2_000_000
COLUMN_TYPES = {"component": "int", "n": "long", "deviation": "long", "whitened": "double", "explained": "double",
                 "identity_error": "double"}


@lru_cache(maxsize=256)
def _triangle(n: int) -> np.ndarray:
    return np.tri(n, dtype=bool)


@np.errstate(divide="ignore", invalid="ignore")
def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``diag(d) + rho * z z^T`` for rising distinct d, z without zeros, rho > 0.

    Returns for each root the index of the pole next to it and its distance from that pole,
    as differences between roots and poles stay exact only that way. Root i lies between
    d[i] and d[i + 1], the last one below d[-1] + rho * |z|^2.
    """
    n = len(d)
    w, own = rho * z * z, np.arange(n)
    gap = np.append(d[1:] - d[:-1], w.sum() * (1 + 4 * n * EPS))
    middle = 1 + (w / (d - (d + gap / 2)[:, None])).sum(1)
    right = (middle < 0) & (own < n - 1)  # the root is in the right half: measured from the pole above
    near = own + right
    delta = d[None, :] - d[near][:, None]
    low = np.where(right, -gap / 2, np.where(middle < 0, gap / 2, 0.0))
    high = np.where(right, 0.0, np.where(middle < 0, gap, gap / 2))
    w_left, w_right = np.where(_triangle(n), w, 0.0), np.where(_triangle(n), 0.0, w)
    t, s = np.empty((n, n)), np.empty((n, n))
    a, b = delta[own, own], np.append(delta[own[:-1], own[1:]], 0.0)
    x = (low + high) / 2
    for _ in range(80):
        np.subtract(delta, x[:, None], out=t)
        np.reciprocal(t, out=t)
        np.multiply(t, t, out=s)
        below, slope_below = np.einsum("ij,ij->i", t, w_left), np.einsum("ij,ij->i", s, w_left)
        above, slope_above = np.einsum("ij,ij->i", t, w_right), np.einsum("ij,ij->i", s, w_right)
        f = 1 + below + above
        low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
        # Both parts as a constant and one pole with the value and slope at x; the last root has no pole above.
        da, db = a - x, b - x
        p, q = slope_below * da * da, slope_above * db * db
        c = f - slope_below * da - slope_above * db
        # c (da - h)(db - h) + p (db - h) + q (da - h) = 0 in the step h
        linear, constant = c * (da + db) + p + q, da * db * f
        root = np.sqrt(np.maximum(linear * linear - 4 * c * constant, 0))
        h = np.where(linear > 0, 2 * constant / (linear + root), (linear - root) / (2 * c))
        h[-1] = da[-1] + p[-1] / (f[-1] - slope_below[-1] * da[-1])
        y = x + h
        y = np.where((y > low) & (y < high), y, (low + high) / 2)
        done = ((np.abs(f) <= 4 * n * EPS * (1 + np.abs(below) + np.abs(above)))
                | (np.abs(y - x) <= 4 * EPS * np.abs(x)))
        x = np.where(done, x, y)
        if done.all():
            break
    return near, x


def rank_one(values: np.ndarray, vectors: np.ndarray, x: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of ``vectors diag(values) vectors^T + rho * x x^T``; values rise, columns are orthonormal.

    A part of x outside the span of the columns becomes a new column with the value 0.
    """
    if rho <= 0 or not x.any():
        return values, vectors
    z = vectors.T @ x
    rest = x - vectors @ z
    again = vectors.T @ rest
    rest, z = rest - vectors @ again, z + again
    size = np.linalg.norm(x)
    if vectors.shape[1] < len(x) and np.linalg.norm(rest) > 1e-10 * size:
        new = np.linalg.norm(rest)
        values, vectors = np.append(0.0, values), np.column_stack((rest / new, vectors))
        z = np.append(new, z)
        order = np.argsort(values, kind="stable")
        values, vectors, z = values[order], vectors[:, order], z[order]
    total = max(values[-1] if len(values) else 0.0, rho * size * size)
    tiny = 8 * EPS * total
    # Equal values: a rotation puts the whole share of the pair on one direction.
    vectors = vectors.copy()
    z = z.copy()
    for i in np.flatnonzero(np.diff(values) <= tiny):
        h = np.hypot(z[i], z[i + 1])
        if h:
            c, s = z[i + 1] / h, z[i] / h
            z[i], z[i + 1] = 0.0, h
            u, v = vectors[:, i].copy(), vectors[:, i + 1].copy()
            vectors[:, i], vectors[:, i + 1] = c * u - s * v, s * u + c * v
    live = rho * np.abs(z) * size > tiny
    if not live.any():
        return values, vectors
    d, w = values[live], z[live]
    near, x_off = secular_roots(d, w, rho)
    from_poles = np.abs((d[near][:, None] - d[None, :]) + x_off[:, None])  # root j to pole i
    signs = np.where(_triangle(len(d)), 1.0, -1.0)
    # The share for which these roots are exact, so that the new vectors are orthogonal: each
    # root but the last is paired with the pole under it, or over it if that is on the far side.
    poles = np.abs(d[:, None] - d[None, :])
    pairs = np.where(_triangle(len(d))[:, :-1] & ~np.eye(len(d), len(d) - 1, dtype=bool), poles[:, :-1], poles[:, 1:])
    exact = np.sqrt(from_poles[-1] * (from_poles[:-1].T / pairs).prod(1) / rho) * np.sign(w)
    columns = (signs * exact[None, :] / from_poles).T
    columns /= np.linalg.norm(columns, axis=0)
    out_values, out = values.copy(), vectors.copy()
    out_values[live] = d[near] + x_off
    out[:, live] = vectors[:, live] @ columns
    order = np.argsort(out_values, kind="stable")
    return out_values[order], out[:, order]


@dataclass
class Spectrum:
    """Count, mean, and the spectrum of the scatter of some vectors."""
    n: float
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, dim: int) -> Spectrum:
        return cls(0.0, np.zeros(dim), np.zeros(0), np.zeros((dim, 0)))

    def add(self, x: np.ndarray) -> None:
        """One more vector: the scatter grows by n / (n + 1) of its centred square."""
        off = x - self.mean
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, off, self.n / (self.n + 1))
        self.n += 1
        self.mean = self.mean + off / self.n

    def combine(self, other: Spectrum) -> None:
        """The vectors of another spectrum, one eigenvector at a time, and the distance of the means."""
        for value, vector in zip(other.values, other.vectors.T):
            self.values, self.vectors = rank_one(self.values, self.vectors, vector, float(value))
        n, off = self.n + other.n, other.mean - self.mean
        if self.n and other.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, off, self.n * other.n / n)
        self.mean = self.mean + off * (other.n / n if n else 0.0)
        self.n = n

    def pack(self) -> bytes:
        return np.concatenate(([self.n, len(self.mean)], self.mean, self.values, self.vectors.ravel())).tobytes()

    @classmethod
    def unpack(cls, data: bytes) -> Spectrum:
        a = np.frombuffer(data)
        dim = int(a[1])
        rank = (len(a) - 2 - dim) // (dim + 1)
        return cls(a[0], a[2:2 + dim], a[2 + dim:2 + dim + rank], a[2 + dim + rank:].reshape(dim, rank))


def _combined_spectra(parts: list[bytes]) -> bytes:
    out = Spectrum.unpack(parts[0])
    for p in parts[1:]:
        out.combine(Spectrum.unpack(p))
    return out.pack()


def _summed(parts: list[bytes]) -> bytes:
    return np.sum([np.frombuffer(p) for p in parts], axis=0).tobytes()


def _per_task(rows: DataFrame, work: Callable[[Iterator[np.ndarray]], bytes | None]) -> DataFrame:
    """One packed result of each task over its matrices of vectors: part, data."""
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = work(m for _, m in _matrices(frames))
        if data is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([data], pa.binary())],
                                             ["part", "data"])
    return rows.select("x").mapInArrow(run, "part long, data binary")


def _tree(parts: DataFrame, merge: Callable[[list[bytes]], bytes]) -> bytes | None:
    """All packed results as one, by groups of FAN_IN; only the last one reaches the driver.

    The results of the tasks are written first, so no later round computes them again.
    """
    def group(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [key[0]], "data": [merge(g.sort_values("part")["data"].tolist())]})

    parts = stage(parts.sparkSession, parts, "whitening-parts")
    top = parts.agg(F.max("part").alias("top")).first().top
    while top:
        parts = parts.groupBy(F.expr(f"part div {FAN_IN}")).applyInPandas(group, "part long, data binary")
        top //= FAN_IN
    last = parts.first()
    return bytes(last.data) if last else None


def _matrices(frames: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of bounded size and their vectors ``x`` as integer matrices."""
    for f in frames:
        at = 0
        while at < f.num_rows:
            dim = len(f.column("x")[at])
            part = f.slice(at, max(1, MATRIX_ENTRIES // dim))
            yield part, part.column("x").flatten().to_numpy().reshape(part.num_rows, dim)
            at += part.num_rows


def quantised(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id and x, the vector as integers ``floor(256 * c)``, saturated at the ends of a long.

    Vectors that are null, empty, or hold a null or non-finite entry are left out, as are those
    whose length is not the most frequent one (the greater of equally frequent ones).
    """
    finite = F.forall(vec_col, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = (vectors.where((F.size(vec_col) > 0) & finite)
            .select(F.col(id_col).alias("vec_id"),
                    F.transform(vec_col, lambda c: F.floor(c.cast("double") * SCALE).cast("long")).alias("x")))
    sizes = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    return rows.where(F.size("x") == (sizes.dim if sizes else 0))


def exact_sums(rows: DataFrame) -> list[int]:
    """Sum of each dimension over all vectors; each task adds up its own before anything moves."""
    def add(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[int] = []
        for _, m in _matrices(frames):
            fits = float(np.abs(m.astype(float)).max()) * len(m) < LONG_MAX / 2
            part = m.sum(0).tolist() if fits else m.astype(object).sum(0).tolist()
            total = [a + b for a, b in zip(total, part)] if total else part
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(map(str, total), pa.string())], ["i", "s"])

    sums = (rows.select("x").mapInArrow(add, "i int, s string").groupBy("i")
            .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    return [int(r.s) for r in sorted(sums)]


@dataclass
class Whitening:
    """A fitted transform: ``(x - sums / n) @ components / sqrt(values)``."""
    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) @ self.components) / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact ``sum((n * x - sums) ** 2)`` of each row; None where it passes a long."""
        off = np.abs(x.astype(float)) * self.n + np.abs(np.array(self.sums, float))
        if (off ** 2).sum(1).max(initial=0) < LONG_MAX / 4:
            return ((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(1).tolist()
        exact = [sum((self.n * int(c) - s) ** 2 for c, s in zip(row, self.sums)) for row in x]
        return [v if v <= LONG_MAX else None for v in exact]


def fit(rows: DataFrame, k: int) -> Whitening | None:
    """The k strongest components of the distinct vectors ``x``; fewer if fewer have a variance. None without rows."""
    spark = rows.sparkSession
    once = stage(spark, rows.select("x").distinct(), "whitening-fit")
    sums, n = exact_sums(once), once.count()
    if not n:
        return None
    dim, mean = len(sums), np.array([s / n for s in sums])

    def spectrum(mats: Iterator[np.ndarray]) -> bytes | None:
        out = None
        for m in mats:
            out = out or Spectrum.empty(m.shape[1])
            for x in m.astype(float):
                out.add(x)
        return out and out.pack()

    combined = Spectrum.unpack(_tree(_per_task(once, spectrum), _combined_spectra))
    # Strongest first, orthonormal to rounding, and completed so that no direction is missing.
    basis = np.linalg.qr(np.column_stack((combined.vectors[:, ::-1], np.eye(dim))))[0]

    def ritz(mats: Iterator[np.ndarray]) -> bytes | None:
        out = None
        for m in mats:
            y = (m - mean) @ basis
            out = y.T @ y if out is None else out + y.T @ y
        return None if out is None else out.tobytes()

    small = np.frombuffer(_tree(_per_task(once, ritz), _summed)).reshape(dim, dim) / n
    values, turns = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(values)[::-1][:k]
    order = order[values[order] > dim * EPS * max(values[-1], 0)]
    model = Whitening(n, sums, basis @ turns[:, order], values[order], float(np.trace(small)))

    def squares(mats: Iterator[np.ndarray]) -> bytes | None:
        out = None
        for m in mats:
            y = model.whitened(m)
            out = y.T @ y if out is None else out + y.T @ y
        return None if out is None else out.tobytes()

    if len(order):
        cov = np.frombuffer(_tree(_per_task(once, squares), _summed)).reshape(len(order), -1) / n
        model.identity_error = float(np.abs(cov - np.eye(len(order))).max())
    return model


def whiten(vectors: DataFrame, *, k: int = 4, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows that ``quantised`` leaves out give no rows. Repeated rows each give theirs, but a
    vector counts once in the fit; a null id stays null. Components without a variance (all of
    them if the table holds one distinct vector) are left out, and so are vectors without any
    component; an empty table gives no rows. A squared deviation beyond a long is null. Other
    columns are not read. ``n`` and all sums are of the distinct vectors.
    """
    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType
    rows = stage(spark, quantised(vectors, id_col, vec_col), "whitening-rows")
    model = fit(rows, k)

    def project(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = len(model.values) if model else 0
        if not parts:
            return
        number = np.arange(1, parts + 1)
        for f, m in _matrices(frames):
            n = len(m)
            yield pa.RecordBatch.from_arrays(
                [f.column("vec_id").take(pa.array(np.repeat(np.arange(n), parts))),
                 pa.array(np.tile(number, n), pa.int32()), pa.array(np.full(n * parts, model.n), pa.int64()),
                 pa.array([d for d in model.deviations(m) for _ in number], pa.int64()),
                 pa.array(model.whitened(m).ravel()), pa.array(np.tile(model.values / model.trace, n)),
                 pa.array(np.full(n * parts, model.identity_error))], ["vec_id", *COLUMN_TYPES])

    kinds = {"vec_id": id_type.simpleString(), **COLUMN_TYPES}
    return rows.mapInArrow(project, ", ".join(f"{c} {kind}" for c, kind in kinds.items()))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``embeddings``, four components."""
    return whiten(read(spark, sf_dir, "embeddings"))


QUERIES = {"op12_whitening": op12_whitening}
ORACLES: dict[str, str] = {}
