"""Exact top-k inner products with an impact-ordered index, score at a time.

Vectors are integers, ``floor(1024 * x)``. Each task cuts its vectors into blocks and each block into posting segments:
for a quantised impact (the size of a component, in steps) and a dimension, the vectors that have it and their
components. Segments are processed by descending impact, for a block of queries at once: a posting adds its part to the
scores. What is still open for a pair is at most the product of the lengths of both vectors' open components
(Cauchy-Schwarz). A level is left out only when that proves, for every query, that all but a few vectors miss the top
``k``; those few are rescored exactly in integers. Scores that a task has proven bound its later blocks.

Queries are sent to the tasks ``QUERY_BLOCK`` at a time, each block in a pass of its own over all vectors, so nothing
grows with their number but the passes. Each task returns ``k`` rows a query; Spark ranks them.

Vectors that are null or hold a null or a component that is not finite take no part, nor do rows without an id. Only
vectors of the same length are compared; empty ones score 0 with each other. Rows with the query's id are the query's
own. Equal query rows count once. Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 1024
BLOCK = 4096
#: Levels of impact, and the share of pairs that may be left for rescoring.
STEPS, RESCORED = 8, 0.02


def integers(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray | None]]:
    """Which vectors take part, and their components as integers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size)
    good = np.isfinite(flat)
    bad = np.concatenate([[0], np.cumsum(~good)])
    taking_part = column.is_valid().to_numpy(zero_copy_only=False) & (bad[ends] == bad[ends - size])
    whole = np.floor(1024.0 * np.where(good, flat, 0))
    return taking_part, [whole[e - n : e] if t else None for e, n, t in zip(ends, size, taking_part, strict=True)]


class Index:
    """Posting segments of a block of vectors, by descending impact."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        size = np.abs(vectors)
        step = max(float(size.max(initial=0)) / STEPS, 1.0)
        level = np.minimum((size / step).astype(np.int64), STEPS - 1)
        self.segments: list[list[tuple[int, np.ndarray, np.ndarray]]] = []
        for k in range(STEPS - 1, -1, -1):
            dimension, at = np.nonzero((level == k).T)
            cuts = np.searchsorted(dimension, np.arange(vectors.shape[1] + 1))
            self.segments.append(
                [(d, at[a:b], vectors[at[a:b], d]) for d, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]
            )
        #: Squared length of each vector's components below each level.
        self.open = [(vectors * vectors * (level < k)).sum(axis=1) for k in range(STEPS - 1, -1, -1)]

    def possible(self, queries: np.ndarray, k: int, floor: np.ndarray, own: tuple = ([], [])) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (vector, query) that may be in the query's top ``k``; ``floor`` is a score that k others have, ``own`` are
        the pairs that don't count."""
        n, m = len(self.vectors), len(queries)
        scores, seen = np.zeros((n, m)), np.zeros((n, m))
        squares = queries * queries
        total = squares.sum(axis=1)
        done = 0
        for segments, rest in zip(self.segments, self.open, strict=True):
            for d, at, values in segments:
                scores[at] += values[:, None] * queries[:, d]
                seen[at] += squares[:, d]
                done += len(at)
            if 2 * done < self.vectors.size:
                continue  # too much is open for a proof
            # A little more than rounding can take away.
            bound = np.sqrt(np.maximum(total - seen, 0) * rest[:, None]) * (1 + 1e-9) + 1e-9 * np.abs(scores)
            least = floor
            if n > k:
                sure = scores - bound
                sure[own] = -np.inf
                least = np.maximum(floor, np.partition(sure, n - k - 1, axis=0)[n - k - 1])
            may = scores + bound >= least
            may[own] = False
            if may.mean() <= RESCORED or not rest.any():
                break
        if not self.vectors.size:
            may = np.ones((n, m), dtype=bool)
            may[own] = False
        return np.nonzero(may)


class Best:
    """The top ``k`` of each query so far."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.queries, self.k = ids, queries, k
        none = np.zeros(0, dtype=np.int64)
        self.rows = (none, none, none)
        self.floor = np.full(len(ids), -np.inf)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Take a block of vectors into account."""
        # However often a query's own rows are repeated, they take no place of the k.
        rows = np.flatnonzero(np.isin(ids, self.ids))
        at, query = np.nonzero(ids[rows][:, None] == self.ids)
        at, query = Index(vectors).possible(self.queries, self.k, self.floor, (rows[at], query))
        whole, wanted = vectors.astype(np.int64), self.queries.astype(np.int64)
        score = np.concatenate(
            [np.einsum("ij,ij->i", whole[at[a : a + 65536]], wanted[query[a : a + 65536]]) for a in range(0, len(at), 65536)]
            or [np.zeros(0, dtype=np.int64)]
        )
        query, vec, score = (np.concatenate([old, new]) for old, new in zip(self.rows, (query, ids[at], score), strict=True))
        by = np.lexsort((vec, -score, query))
        query, vec, score = query[by], vec[by], score[by]
        first = np.searchsorted(query, np.arange(len(self.ids)))
        rank = np.arange(len(query)) - first[query]
        last = rank == self.k - 1
        self.floor[query[last]] = score[last]
        keep = rank < self.k
        self.rows = query[keep], vec[keep], score[keep]


def _search(blocks: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {size: Best(ids, vectors, k) for size, (ids, vectors) in blocks.items()}
        for batch in batches:
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            _, vectors = integers(batch.column("vector"))
            for size in best:
                own = np.array([n for n, v in enumerate(vectors) if v is not None and len(v) == size], dtype=np.int64)
                for a in range(0, len(own), BLOCK):
                    part = own[a : a + BLOCK]
                    best[size].add(ids[part].astype(np.int64), np.stack([vectors[n] for n in part]))
        for found in best.values():
            query, vec, score = found.rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.ids[query]), pa.array(vec), pa.array(score)], names=["query_id", "vec_id", "score"]
            )

    return run


def query_blocks(queries: DataFrame, most: int = QUERY_BLOCK) -> Iterator[dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Some queries at a time, by the length of their vectors."""

    def arranged(rows: list) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        _, vectors = integers(pa.array([r[1] for r in rows], pa.list_(pa.float64())))
        sizes = {}
        for row, vector in zip(rows, vectors, strict=True):
            if vector is not None:
                sizes.setdefault(len(vector), []).append((row[0], vector))
        return {n: (np.array([i for i, _ in x], dtype=np.int64), np.stack([v for _, v in x])) for n, x in sizes.items()}

    rows = []
    for row in queries.toLocalIterator():
        rows.append(row)
        if len(rows) == most:
            yield arranged(rows)
            rows = []
    if rows:
        yield arranged(rows)


def search(vectors: DataFrame, is_query: Column, k: int = 10, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest scores of each row with ``is_query`` among all other rows."""
    rows = vectors.filter(F.col(id).isNotNull() & F.col(vector).isNotNull())
    queries = rows.filter(is_query).select(F.col(id).cast("long"), F.col(vector).cast("array<double>")).distinct()
    rows = rows.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    schema = "query_id long, vec_id long, score long"
    passes = [rows.mapInArrow(_search(block, k), schema) for block in query_blocks(queries) if block]
    found = reduce(DataFrame.union, passes) if passes else vectors.sparkSession.createDataFrame([], schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
