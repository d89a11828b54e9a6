"""Whitening of vectors: principal components and their deviations by Golub-Kahan-Lanczos bidiagonalisation.

Entries become integers ``x = floor(scale * c) + shift``. The fit list holds each distinct vector once. With ``X`` its
centred rows, the bidiagonalisation finds orthonormal ``v_j`` (one entry per dimension) and ``u_j`` (one per row) with
``X v_j = beta_{j-1} u_{j-1} + alpha_j u_j`` and ``X' u_j = alpha_j v_j + beta_j v_{j+1}``. Rows stay where they are: a
``u_j`` is the product of ``X`` with a short vector ``w_j``, so each step is one pass in which a task multiplies its rows with ``w``,
which makes its share of ``u``, and then that with its rows again; Spark adds up one number per dimension. Both sides are
reorthogonalised in full, twice: ``v`` against all earlier ones, and ``u`` through ``<u_i, X w> = (X' u_i) w``. The
singular values of the small bidiagonal matrix are the deviations, its right vectors make the components. All dimensions
are run through, and a new direction is drawn where a step ends in a vector of zeros, so that equal and vanishing
deviations are found too.

Centring is exact: the sums are integers, and a row is shifted by the whole part of the mean before the fraction is taken off.
The driver holds numbers per dimension, no rows.

Left out: vectors that are null, empty, hold null or entries that are not finite, entries of 2**40 or more in size, and
vectors of another length than most (of equally frequent lengths the longest counts). Repeated rows count once in the
fit and each have a result; a null id is an id like any other. Components with a deviation of zero (one vector, constant
dimensions, more dimensions than vectors) have no whitened entry. An empty table gives an empty result. Only the named
columns are read. Equal deviations have an arbitrary rotation among them, the same for all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signwatch.llm.tables import written

SCALE, SHIFT = 64, 1_000_000

#: Sizes from which on an entry is left out, so that sums of integers stay exact within a batch.
LARGE = float(1 << 40)


@dataclass
class Whitening:
    """``n`` distinct vectors, their integer sums, components as columns, eigenvalues, share of the trace of each."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """Whole parts and fractions of the means."""
        return np.array([s // self.n for s in self.sums], dtype=np.int64), np.array([s % self.n / self.n for s in self.sums])


def usable(vector: Column) -> Column:
    """Neither null nor empty, every entry finite and below the limit."""
    fine = lambda c: F.coalesce(F.abs(c.cast("double")) < LARGE, F.lit(False)) & ~F.isnan(c)
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, fine)


def integers(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``id, x`` of the usable vectors with the most frequent length."""
    rows = vectors.select(F.col(id).alias("id"), F.col(vector).alias("c")).filter(usable(F.col("c")))
    length = rows.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    rows = rows.filter(F.size("c") == (length["d"] if length else 0))
    return rows.select("id", F.transform("c", lambda c: F.floor(c.cast("double") * scale) + shift).cast("array<long>").alias("x"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _added(rows: DataFrame, run: Callable, width: int, kind: str) -> list:
    """Sums over all tasks of the ``width`` numbers that ``run`` makes of each batch's ``x``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(run(batch.column("x")))], names=["k", "part"])

    parts = rows.select("x").mapInArrow(task, f"k int, part {'long' if kind == 'long' else 'double'}")
    total = F.sum(F.col("part").cast("decimal(38,0)")) if kind == "long" else F.sum("part")
    out = [0] * width
    for row in parts.groupBy("k").agg(total.alias("total")).collect():
        out[row["k"]] = int(row["total"]) if kind == "long" else row["total"]
    return out


def _orthogonal(v: np.ndarray, to: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for u in to:
            v = v - (u @ v) * u
    return v


def _direction(rng: np.random.Generator, to: list[np.ndarray], dim: int) -> np.ndarray:
    v = _orthogonal(rng.standard_normal(dim), to)
    return v / np.linalg.norm(v)


def bidiagonal(product: Callable[[np.ndarray], tuple[float, np.ndarray]], dim: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Singular values and right vectors of ``X`` with ``dim`` columns; ``product(w)`` is ``|X w|**2`` and ``X' X w``."""
    rng = np.random.default_rng(seed)
    vs, ws, zs = [_direction(rng, [], dim)], [], []
    square, above = np.zeros((dim, dim)), 0.0
    for j in range(dim):
        w = vs[j]
        for _ in range(2):
            for w_i, z_i in zip(ws, zs, strict=True):
                w = w - (z_i @ w) * w_i
        size, z = product(w)
        alpha = np.sqrt(size)
        above = max(above, alpha, np.linalg.norm(z) / alpha if alpha else 0.0)
        gone = alpha <= 1e-13 * above or not alpha
        square[j, j] = 0.0 if gone else alpha
        ws.append(np.zeros(dim) if gone else w / alpha)
        zs.append(np.zeros(dim) if gone else z / alpha)
        if j + 1 == dim:
            break
        v = _orthogonal(zs[j], vs)
        beta = np.linalg.norm(v)
        if beta <= 1e-13 * above or not beta:
            vs.append(_direction(rng, vs, dim))
        else:
            square[j, j + 1] = beta
            vs.append(_orthogonal(v / beta, vs))
            vs[-1] /= np.linalg.norm(vs[-1])
    _, values, right = np.linalg.svd(square)
    return values, np.array(vs).T @ right.T


def fit(x: DataFrame, most: int = 16) -> Whitening | None:
    """The whitening of the distinct rows of ``x``, with at most ``most`` components; none of an empty table."""
    rows = written(x.select("x").distinct(), "fit-list")
    n = rows.count()
    if not n:
        return None
    dim = rows.select(F.size("x")).first()[0]
    sums = _added(rows, lambda c: _matrix(c, dim).sum(axis=0), dim, "long")
    model = Whitening(n, sums, np.zeros((dim, 0)), np.zeros(0), np.zeros(0), 0.0)
    whole, fraction = model.centre()

    def product(w: np.ndarray) -> tuple[float, np.ndarray]:
        def run(column: pa.Array) -> np.ndarray:
            own = (_matrix(column, dim) - whole) - fraction
            u = own @ w
            return np.concatenate([[u @ u], own.T @ u])

        found = np.array(_added(rows, run, dim + 1, "double"))
        return found[0], found[1:]

    values, vectors = bidiagonal(product, dim)
    kept = int((values[:most] > 1e-12 * max(values[0], 1e-300)).sum())
    model.components, model.eigenvalues = vectors[:, :kept], values[:kept] ** 2 / n
    if kept:
        scaled = model.components / np.sqrt(model.eigenvalues)

        def check(column: pa.Array) -> np.ndarray:
            own = (_matrix(column, dim) - whole) - fraction
            y = own @ scaled
            return np.concatenate([[np.einsum("ij,ij->", own, own)], y.sum(axis=0), (y.T @ y).ravel()])

        found = np.array(_added(rows, check, 1 + kept + kept * kept, "double")) / n
        mean, second = found[1 : 1 + kept], found[1 + kept :].reshape(kept, kept)
        model.explained = model.eigenvalues / found[0]
        model.identity_error = float(np.abs(second - np.outer(mean, mean) - np.eye(kept)).max())
    return model


def _deviations(away: np.ndarray, n: int, rest: np.ndarray) -> pa.Array:
    """Sums of ``(n * away - rest)**2`` per row, exact; null where one doesn't fit into a long."""
    limit = 2**63
    top = n * int(np.abs(away).max(initial=0)) + n
    if top * top * away.shape[1] < limit:
        return pa.array(np.square(n * away - rest).sum(axis=1))
    exact = ((n * away.astype(object) - rest.astype(object)) ** 2).sum(axis=1)
    return pa.array([int(e) if e < limit else None for e in exact], pa.int64())


def transform(x: DataFrame, model: Whitening | None) -> DataFrame:
    """One row per row of ``id, x``: ``id, deviation`` (squared distance from the sums, times n squared), ``whitened`` (array)."""
    schema = f"id {x.schema['id'].dataType.simpleString()}, deviation long, whitened array<double>"
    if model is None:
        return x.sparkSession.createDataFrame([], schema)
    whole, fraction = model.centre()
    n, rest, dim = model.n, np.array([s % model.n for s in model.sums], dtype=np.int64), len(model.sums)
    scaled = model.components / np.sqrt(model.eigenvalues)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            away = _matrix(batch.column("x"), dim) - whole
            y = (away - fraction) @ scaled
            ends = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * y.shape[1])
            arrays = [batch.column("id"), _deviations(away, n, rest), pa.ListArray.from_arrays(ends, pa.array(y.ravel()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "deviation", "whitened"])

    return x.select("id", "x").mapInArrow(task, schema)
