"""Approximate nearest neighbours by collision counting, for the largest inner product.

Vectors get one more component that gives all of them the same norm, so that the
largest inner product is the smallest distance. A block of vectors keeps one
sorted array for each of *m* random projections. Round by round the window
around a query's own projection widens (virtual rehashing: a wider window is the
union of narrower ones, so nothing is hashed again), and every vector counts in
how many arrays it has come into the window. Vectors that reach the collision
threshold are verified by their exact inner product; a query stops when enough
have. Every vector is indexed; blocks of queries meet blocks of vectors, so a
task holds two bounded blocks.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

#: Rows of a block of vectors and of a block of queries.
VECTOR_BLOCK, QUERY_BLOCK = 8192, 2048


class CollisionIndex:
    """Sorted projections of one block of vectors."""

    def __init__(self, vectors: np.ndarray, unit: float, largest_norm: float, projections: int = 32, seed: int = 11):
        """*largest_norm* is that of the vectors divided by *unit*, the largest component of all."""
        scaled = vectors / unit / largest_norm
        last = np.sqrt(np.maximum(0.0, 1.0 - (scaled**2).sum(axis=1)))
        self.vectors = vectors
        self.axes = np.random.default_rng(seed).normal(size=(vectors.shape[1] + 1, projections))
        values = np.column_stack([scaled, last]) @ self.axes
        self.order = np.argsort(values, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(values, self.order.T, axis=0).T.copy()

    def candidates(self, queries: np.ndarray, share: float, at_least: int, threshold: float = 0.5, width: float = 0.4, growth: float = 1.5):
        """For each query the vectors verified: those that share *threshold* of the windows when *share* of all do.

        *width* is the half-width of the first window, *growth* the factor from
        round to round. The windows go on to widen until at least *share* of the
        vectors (and *at_least* of them) have reached the threshold.
        """
        projections, n = self.order.shape
        # Scaled first, as squares of very small or large components are 0 or infinite.
        directions = queries / np.abs(queries).max(axis=1, keepdims=True)
        directions /= np.sqrt((directions**2).sum(axis=1, keepdims=True))
        centres = directions @ self.axes[:-1]
        needed = min(n, max(at_least, int(np.ceil(share * n))))
        collisions = max(1, int(np.ceil(threshold * projections)))
        low = np.stack([np.searchsorted(self.values[j], centres[:, j]) for j in range(projections)], axis=1)
        high = low.copy()
        counts = np.zeros((len(queries), n), np.int16)
        active = np.arange(len(queries))
        while len(active):
            for j in range(projections):
                new_low = np.searchsorted(self.values[j], centres[active, j] - width, "left")
                new_high = np.searchsorted(self.values[j], centres[active, j] + width, "right")
                order = self.order[j]
                for q, a, b in zip(active.tolist(), new_low.tolist(), new_high.tolist()):
                    row = counts[q]
                    row[order[a : low[q, j]]] += 1
                    row[order[high[q, j] : b]] += 1
                low[active, j], high[active, j] = new_low, new_high
            active = active[(counts[active] >= collisions).sum(axis=1) < needed]
            width *= growth
        for row in counts:
            yield np.flatnonzero(row >= collisions)

    def search(self, ids: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, share: float):
        """``query, vec, score`` arrays of the *k* best verified vectors of this block for each query."""
        found_query, found_id, found_score = [], [], []
        for query_id, query, near in zip(query_ids.tolist(), queries, self.candidates(queries, share, k + 1)):
            near = near[ids[near] != query_id]
            scores = self.vectors[near] @ query
            if len(near) > k:
                kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                near = near[scores >= kth - 1e-9 * np.abs(scores).max()] if np.isfinite(scores).all() else near
            # Summed row by row, so that equal vectors tie exactly.
            scores = (self.vectors[near] * query).sum(axis=1)
            best = np.lexsort((ids[near], -scores))[:k]
            found_query.append(np.full(len(best), query_id))
            found_id.append(ids[near[best]])
            found_score.append(scores[best])
        return tuple(np.concatenate(x) for x in (found_query, found_id, found_score))


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id, vector`` of the rows that take part.

    Left out are rows without an id, vectors that are NULL, empty or zero, and those that hold a
    NULL or non-finite component.
    """
    real = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("vector"))
    return real.filter(
        F.col("vec_id").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )


def nearest(vectors: DataFrame, is_query, k: int = 20, share: float = 0.6, projections: int = 24) -> DataFrame:
    """``query_id, rank, vec_id, score``: the *k* nearest found for every row for which *is_query* holds.

    Nearness is the inner product in double precision, ties go to the smaller
    ``vec_id``; a query is no neighbour of its own id. *share* of every block is
    verified at least: vectors spread evenly in all directions, as the worst
    case, need about half of them for a recall of 0.9 and more. Vectors of another length than
    a query's are no neighbours of it: every length is a space of its own. Repeated rows are neighbours of their own.
    Components may be of any finite size; a score beyond a double is infinite. An empty table gives no rows.
    """
    rows = usable(vectors).withColumn("size", F.size("vector"))
    unit = F.array_max(F.transform("vector", F.abs))
    units = rows.groupBy("size").agg(F.max(unit).alias("unit"))
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + (x / F.col("unit")) * (x / F.col("unit")))
    blocks = lambda n, size: F.greatest(F.lit(1), F.ceil(n / size)).cast("int")
    sizes = rows.join(units, "size").groupBy("size", "unit").agg(
        F.sqrt(F.max(square)).alias("norm"),
        blocks(F.count(F.lit(1)), VECTOR_BLOCK).alias("vector_blocks"),
        blocks(F.count_if(is_query), QUERY_BLOCK).alias("query_blocks"),
    )
    rows = rows.join(sizes, "size")

    def blocked(frame, own: str, other: str):
        block = F.pmod(F.xxhash64("vec_id", f"{own}_blocks"), F.col(f"{own}_blocks")).cast("int").alias(f"{own}_block")
        others = F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)).alias(f"{other}_block")
        return frame.select("vec_id", "vector", "size", "unit", "norm", block, others)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if left.num_rows and right.num_rows:
            matrix = lambda t: t.column("vector").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
            unit, norm = (left.column(c)[0].as_py() for c in ("unit", "norm"))
            index = CollisionIndex(matrix(left), unit, norm * (1 + 1e-12), projections)
            queries, query_ids = matrix(right), right.column("vec_id").to_numpy()
            found = [
                index.search(left.column("vec_id").to_numpy(), query_ids[i : i + 256], queries[i : i + 256], k, share)
                for i in range(0, len(queries), 256)
            ]
            parts = [np.concatenate(x) for x in zip(*found)]
        return pa.table({"query_id": parts[0].astype(np.int64), "vec_id": parts[1].astype(np.int64), "score": parts[2]})

    keys = ["size", "vector_block", "query_block"]
    data = blocked(rows, "vector", "query").groupBy(*keys)
    asked = blocked(rows.filter(is_query), "query", "vector")
    asked = asked.toDF(*asked.columns)  # columns of its own, as both sides come from the same rows
    found = data.cogroup(asked.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)
