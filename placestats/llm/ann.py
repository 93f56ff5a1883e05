"""Approximate nearest neighbours by counting collisions in windows around the query.

Rows are dealt into blocks of bounded size and queries into blocks, too; every pair of a
row block and a query block is one unit of work, keyed by both numbers, so no task holds
more than two blocks. In a unit every vector has one number per random projection, kept
as one sorted array per projection. A query opens a window around its own number in each
array; virtual rehashing widens all windows together, step by step, and a row that lies
in the windows of enough projections is verified by its true distance. The search of a
block ends when `k` verified rows lie within the present radius, so that the rows not yet
verified are, but for the stated chance, further away; a block that has no more rows
ends with all of them verified. The best `k` of all blocks are the result.
"""

from __future__ import annotations

from math import erf, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PROJECTIONS = 64
ROW_BLOCK, QUERY_BLOCK = 8192, 1024
WINDOW = 2.0  # width of a window in units of the radius
SPARE = 1.5  # standard deviations by which the threshold lies below the expected collisions
GROWTH = 1.15  # of the radius in one step of virtual rehashing


def threshold(projections: int = PROJECTIONS, window: float = WINDOW, spare: float = SPARE) -> int:
    """Collisions that a row at exactly the radius reaches but for `spare` standard deviations."""
    p = erf(window / 2 / sqrt(2))
    return max(1, int(projections * p - spare * sqrt(projections * p * (1 - p))))


def directions(width: int, projections: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, width]).normal(size=(width, projections))


class Block:
    """Sorted projections of a block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, planes: np.ndarray):
        self.ids, self.vectors = ids, vectors
        numbers = np.ascontiguousarray((vectors @ planes).T)
        order = np.argsort(numbers, axis=1)
        # all arrays as one ascending array, so that the windows of all projections are found by one search
        self.step = 4 * float(np.abs(numbers).max()) + 1
        self.order = order.ravel()
        self.sorted = (np.take_along_axis(numbers, order, axis=1) + self.step * np.arange(len(numbers))[:, None]).ravel()

    def edges(self, at: np.ndarray, side: str) -> np.ndarray:
        """Where the numbers `at`, one per projection, fall in the one ascending array."""
        inside = np.clip(at, -self.step * 0.49, self.step * 0.49)  # beyond all numbers of its own projection only
        return np.searchsorted(self.sorted, inside + self.step * np.arange(len(at)), side)

    def start_radius(self, query: np.ndarray, k: int) -> float:
        """A radius from below: the k-th distance among some rows, scaled down."""
        some = self.vectors[:: max(1, len(self.vectors) // 64)]
        near = np.sort(np.sqrt(((some - query) ** 2).sum(axis=1)))
        return float(near[min(k, len(near)) - 1]) / 2

    def search(self, query: np.ndarray, own: np.ndarray, at: np.ndarray, k: int, window: float, least: int) -> list[tuple[float, int]]:
        """The k nearest verified rows as (distance, id). own: rows that are the query itself; at: its numbers."""
        n, m = len(self.ids), len(at)
        count = np.zeros(n, np.int32)
        skip = own.copy()
        low = self.edges(at, "left")
        high = low.copy()
        first, last = n * np.arange(m), n * np.arange(1, m + 1)
        distances = np.zeros(0)
        rows = np.zeros(0, np.int64)
        radius = self.start_radius(query, k)
        while True:
            half = radius * window / 2
            new_low = np.minimum(self.edges(at - half, "left"), low)
            new_high = np.maximum(self.edges(at + half, "right"), high)
            grown = [self.order[a:b] for a, b in zip([*new_low, *high], [*low, *new_high]) if a < b]
            low, high = new_low, new_high
            if grown:
                count += np.bincount(np.concatenate(grown), minlength=n).astype(np.int32)
            hit = np.flatnonzero((count >= least) & ~skip)
            if len(hit):
                skip[hit] = True
                rows = np.concatenate([rows, hit])
                distances = np.concatenate([distances, np.sqrt(((self.vectors[hit] - query) ** 2).sum(axis=1))])
            if (distances <= radius).sum() >= k or len(rows) + own.sum() == n:
                break
            if (low == first).all() and (high == last).all():
                continue  # every row lies in every window, so all are verified in the next look
            radius = radius * GROWTH if radius > 0 else self.spread()
        best = np.lexsort((self.ids[rows], distances))[:k]
        return [(float(distances[i]), int(self.ids[rows[i]])) for i in best]

    def spread(self) -> float:
        """The least positive step for queries that start among equal vectors."""
        return (self.step - 1) / 4000 if self.step > 1 else 1.0


def usable(vector):
    """Not null, not zero, all components finite numbers."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & good & F.exists(vector, lambda x: x != 0)


def nearest(rows: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, projections: int = PROJECTIONS,
            row_block: int = ROW_BLOCK, query_block: int = QUERY_BLOCK, seed: int = 11) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` nearest rows of every query, ties to the smaller id.

    A row with the query's own id is no candidate of it. Vectors that are null, zero or
    not finite take no part, nor do rows without an id; queries meet only rows of their
    own width. Rows that repeat an id and vector count once.
    """
    wide = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    wide = wide.where(F.col("id").isNotNull() & usable(F.col("v"))).withColumn("d", F.size("v")).distinct()
    asked = queries.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    asked = asked.where(F.col("id").isNotNull() & usable(F.col("v"))).withColumn("d", F.size("v")).distinct()
    sizes = [df.groupBy("d").agg(F.count(F.lit(1)).alias(n)) for df, n in ((wide, "rows"), (asked, "asked"))]
    blocks = sizes[0].join(sizes[1], "d").select(
        "d", F.ceil(F.col("rows") / row_block).cast("int").alias("rb"), F.ceil(F.col("asked") / query_block).cast("int").alias("qb")
    )
    others = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    mine = lambda n: F.pmod(F.xxhash64("id", "v"), F.col(n)).cast("int")
    left = wide.join(blocks, "d").select("d", mine("rb").alias("rb"), others("qb").alias("qb"), "id", "v")
    right = asked.join(blocks, "d").select("d", others("rb").alias("rb"), mine("qb").alias("qb"), "id", "v")
    least = threshold(projections)

    def unit(points: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(points) and len(wanted):
            points, wanted = points.sort_values("id", kind="stable"), wanted.sort_values("id", kind="stable")
            vectors = np.stack(points["v"].to_numpy())
            planes = directions(vectors.shape[1], projections, seed)
            block = Block(points["id"].to_numpy(), vectors, planes)
            for qid, query in zip(wanted["id"].to_numpy(), wanted["v"].to_numpy()):
                found = block.search(query, block.ids == qid, query @ planes, k, WINDOW, least)
                out += [(int(qid), i, score) for score, i in found]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    key = ["d", "rb", "qb"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(unit, "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
