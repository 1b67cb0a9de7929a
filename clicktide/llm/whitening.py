"""Embedding whitening with eigenvectors refined in mixed precision.

Vectors are counted in whole steps of ``1 / SCALE``, so sums, deviations and the centred second
moments are exact integers, the same whatever the partitioning. Each task adds up its own moments,
row by row of the matrix, and these are merged by matrix row; only the covariance, whose size is set
by the number of dimensions, reaches the driver.

There the eigenvectors of a float32 copy are corrected by Ogita and Aishima's iteration: with
``R = I - X'X`` and ``S = X'VX`` the eigenvalues are ``S_ii / (1 - R_ii)`` and ``X`` becomes
``X + XE`` for an ``E`` made of ``R`` and ``S``, all by matrix products in extended precision. Each
step doubles the correct digits of well-separated vectors. Neighbouring eigenvalues too close for
the step's error form a cluster: there ``E`` only makes the vectors orthonormal, and the small
problem ``X_c' (V - mu I) X_c``, shifted so that its differences keep their digits, is refined by itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Eigenvalues below this share of the greatest are no directions of the data.
RANK_TOLERANCE = 1e-13
MAX_STEPS = 40
#: Entries from here on are no whole steps whose moments would fit what carries them.
TOO_LARGE = 2.0**38
_HALF = 1 << 62


def steps_of(vectors: DataFrame) -> DataFrame:
    """(vec_id, x) in whole steps, of the rows whose vector takes part.

    Out are vectors that are null, empty, or hold a null, a non-finite or a ``TOO_LARGE`` entry;
    and those of another length than most (of equally frequent lengths the longest stays)."""
    value = F.col("embedding").cast("array<double>")
    x = F.transform(value, lambda v: F.floor(v * SCALE) + OFFSET)
    usable = F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < TOO_LARGE))
    rows = vectors.where("embedding IS NOT NULL AND size(embedding) > 0").where(usable)
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), x.alias("x"))
    lengths = rows.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n"))
    width = lengths.agg(F.max_by("width", F.struct("n", "width"))).first()[0]
    return rows.where(F.size("x") == F.lit(width or 0))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The batch's vectors as rows of whole steps."""
    column = batch.column("x")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def exact_gram(d: np.ndarray) -> np.ndarray:
    """``d.T @ d`` as Python integers; sums of products are exact in doubles below 2^53."""
    top = int(np.abs(d).max(initial=0)) ** 2
    if top >= 1 << 53:
        return d.T.astype(object) @ d.astype(object)
    rows = ((1 << 53) - 1) // max(top, 1)
    total = np.zeros((d.shape[1], d.shape[1]), dtype=object)
    for i in range(0, len(d), rows):
        part = d[i : i + rows].astype(float)
        total += (part.T @ part).astype(np.int64)
    return total


def _summed(data: DataFrame, of_batch: Callable[[np.ndarray], np.ndarray]) -> dict[int, list[int]]:
    """Sum over all batches of a matrix of integers, by matrix row.

    A task sends each row once, as two halves of its integers, and rows are merged by number; so
    neither a task nor the driver holds more than the matrix."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (of_batch(_matrix(b)) for b in batches if b.num_rows)
        total = next(parts, None)
        for part in parts:
            total = total + part
        if total is not None:
            yield _halves(range(len(total)), total)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, a, b in zip(*(batch.column(c).to_pylist() for c in ("i", "high", "low"))):
                row = np.array(a, dtype=object) * _HALF + np.array(b, dtype=object)
                total[i] = total.get(i, 0) + row
        if total:
            yield _halves(total, total.values())

    schema = "i int, high array<bigint>, low array<bigint>"
    merged = data.mapInArrow(local, schema).repartition("i").mapInArrow(merge, schema)
    return {r.i: [a * _HALF + b for a, b in zip(r.high, r.low)] for r in merged.collect()}


def _halves(index: Iterable[int], rows: Iterable) -> pa.RecordBatch:
    split = [[divmod(int(v), _HALF) for v in row] for row in rows]
    high, low = ([[v[side] for v in row] for row in split] for side in (0, 1))
    kind = pa.list_(pa.int64())
    arrays = [pa.array(list(index), pa.int32()), pa.array(high, kind), pa.array(low, kind)]
    return pa.RecordBatch.from_arrays(arrays, ["i", "high", "low"])


@dataclass(frozen=True)
class Moments:
    """Number of rows, exact sums per dimension, and ``n^2`` times the exact covariance."""

    n: int
    sums: list[int]
    scatter: np.ndarray

    @property
    def centre(self) -> np.ndarray:
        """The means, to the nearest whole step."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], dtype=np.int64)

    @property
    def rest(self) -> np.ndarray:
        """``n`` times what the centre leaves of the means."""
        return np.array([s - self.n * int(c) for s, c in zip(self.sums, self.centre)], dtype=object)

    def covariance(self) -> np.ndarray:
        square = self.n * self.n
        parts = [[divmod(int(v), square) for v in row] for row in self.scatter]
        whole = np.array([[p[0] for p in row] for row in parts], dtype=np.longdouble)
        return whole + np.array([[p[1] for p in row] for row in parts], dtype=np.longdouble) / square

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sum over dimensions of ``(n x - S)^2`` per row; None beyond a 64-bit integer."""
        d, rest = x - self.centre, self.rest
        far = int(np.abs(d).max(initial=0)) * self.n + max(map(abs, rest.tolist()), default=0)
        if far * far * max(len(rest), 1) < 1 << 63:
            y = d * self.n - rest.astype(np.int64)
            return (y * y).sum(axis=1).tolist()
        y = d.astype(object) * self.n - rest
        return [v if v < 1 << 63 else None for v in (y * y).sum(axis=1).tolist()]


def moments(steps: DataFrame) -> Moments | None:
    """Moments of all rows, from one pass for the sums and one centred on them; None without rows."""

    def sums(x: np.ndarray) -> np.ndarray:
        return np.append(x.sum(axis=0), len(x)).astype(object)[None]

    found = _summed(steps, sums)
    if not found:
        return None
    *total, n = found[0]
    first = Moments(n, total, np.zeros((0, 0)))
    centre, rest = first.centre, first.rest
    gram = _summed(steps, lambda x: exact_gram(x - centre))
    whole = np.array([gram[i] for i in range(len(total))], dtype=object)
    # Centred on whole steps before multiplying; what these leave of the means is taken off exactly.
    return Moments(n, total, n * whole - np.outer(rest, rest))


def refined_eigenvectors(v: np.ndarray, noise: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, in extended precision.

    ``noise`` bounds the error of the entries; differences below it part no eigenvectors."""
    v = np.asarray(v, dtype=np.longdouble)
    n = len(v)
    one = np.eye(n, dtype=np.longdouble)
    mean = np.trace(v) / max(n, 1)
    a = v - mean * one
    scale = np.abs(a).max(initial=0)
    noise = max(float(noise), float(np.finfo(np.longdouble).eps * n * np.abs(v).max(initial=0)))
    if scale <= 4 * noise:
        return np.full(n, mean), one
    a /= scale
    noise /= float(scale)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    norm = np.sqrt((a * a).sum())
    last = np.inf
    for _ in range(MAX_STEPS):
        # Symmetric to the last digit, so that the steps keep the vectors orthonormal.
        r = one - _halved_sum(x.T @ x)
        s = _halved_sum(x.T @ a @ x)
        value = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        error = 2 * (np.sqrt((off * off).sum()) + norm * np.sqrt((r * r).sum()))
        order = np.argsort(-value, kind="stable")
        # The greatest gap exceeds 1 / n, so these are never all in one cluster for long.
        clusters = _clusters(value[order], max(error, np.longdouble(1) / (4 * n)))
        together = np.zeros((n, n), bool)
        for first, end in clusters:
            together[np.ix_(order[first:end], order[first:end])] = True
        gap = np.where(together, 1, value[None, :] - value[:, None])
        e = np.where(together, r / 2, (s + value[None, :] * r) / gap)
        x = x + x @ e
        for first, end in clusters:
            if 1 < end - first:
                x[:, order[first:end]] = _solved_cluster(a, x[:, order[first:end]], noise)
        size = float(np.abs(e).max())
        if size < 1e-18 or last < 1e-12 and size > last / 4:
            break
        last = size
    value = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-value, kind="stable")
    x = x / np.sqrt((x * x).sum(axis=0))
    return mean + scale * value[order], x[:, order]


def _halved_sum(m: np.ndarray) -> np.ndarray:
    return (m + m.T) / 2


def _clusters(falling: np.ndarray, width: float) -> list[tuple[int, int]]:
    """Intervals of neighbouring eigenvalues with no gap wider than ``width``."""
    cuts = np.flatnonzero(falling[:-1] - falling[1:] > width) + 1
    edges = [0, *cuts.tolist(), len(falling)]
    return list(zip(edges[:-1], edges[1:]))


def _solved_cluster(a: np.ndarray, x: np.ndarray, noise: float) -> np.ndarray:
    """Vectors of one cluster, turned within the space they span so that they part."""
    q = x.copy()
    for j in range(q.shape[1]):  # orthonormal first; twice is enough
        for _ in range(2):
            q[:, j] -= q[:, :j] @ (q[:, :j].T @ q[:, j])
        q[:, j] /= np.sqrt((q[:, j] ** 2).sum())
    if q.shape[1] == len(a):
        return q
    image = a @ q
    shift = np.einsum("ij,ij->", q, image) / q.shape[1]
    # Shifted before the product, the small problem keeps the digits of its differences.
    return q @ refined_eigenvectors(_halved_sum(q.T @ (image - shift * q)), noise)[1]


@dataclass(frozen=True)
class Whitening:
    """A fit: moments, the kept components as columns, their eigenvalues and shares of the trace."""

    moments: Moments
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of rows of whole steps."""
        mean = (self.moments.rest / self.moments.n).astype(float)
        return ((x - self.moments.centre) - mean) @ (self.vectors / np.sqrt(self.values))


def fit(steps: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Principal directions of all rows; None where no row or no direction is left."""
    found = moments(steps)
    if found is None:
        return None
    covariance = found.covariance()
    values, vectors = (part.astype(float) for part in refined_eigenvectors(covariance))
    kept = int((values > RANK_TOLERANCE * max(values[0], 0.0)).sum()) if values[0] > 0 else 0
    kept = min(kept, components)
    if not kept:
        return None
    explained = values[:kept] / float(np.trace(covariance))
    return Whitening(found, vectors[:, :kept], values[:kept], explained)


def identity_error(steps: DataFrame, fitted: Whitening) -> float:
    """Largest entry, in size, of the whitened rows' covariance minus the identity."""
    k = len(fitted.values)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = fitted.apply(_matrix(batch)) if batch.num_rows else np.zeros((0, k))
            total += np.vstack([w.T @ w, w.sum(axis=0)])
        yield pa.RecordBatch.from_pydict({"values": [total.ravel()]})

    sums = steps.mapInArrow(local, "values array<double>").select(F.posexplode("values").alias("i", "v"))
    rows = sums.groupBy("i").agg(F.sum("v").alias("v")).collect()  # k * (k + 1) of them
    total = np.array([r.v for r in sorted(rows, key=lambda r: r.i)]).reshape(k + 1, k) / fitted.moments.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


_SCHEMA = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
    "explained double, identity_error double"
)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row per vector that takes part (see ``steps_of``) and component, from 1 in falling order.

    There are as many components as the data have directions, ``components`` at most; equal vectors
    or a single one have none, so the result is empty, as it is for an empty table. Rows that repeat
    a vec_id, or have none, count and are returned like others. ``deviation`` is null where it does
    not fit a long. Other columns are ignored.
    """
    spark = vectors.sparkSession
    steps = steps_of(vectors)
    fitted = fit(steps, components)
    if fitted is None:
        return spark.createDataFrame([], _SCHEMA)
    error = identity_error(steps, fitted)
    k = len(fitted.values)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch)
            m = len(x)
            of_row = np.repeat(np.arange(m), k)
            columns = [
                batch.column("vec_id").take(pa.array(of_row)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, fitted.moments.n)),
                pa.array(fitted.moments.deviations(x), pa.int64()).take(pa.array(of_row)),
                pa.array(fitted.apply(x).ravel()),
                pa.array(np.tile(fitted.explained, m)),
                pa.array(np.full(m * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _SCHEMA.split(", ")])

    return steps.mapInArrow(rows, _SCHEMA)
