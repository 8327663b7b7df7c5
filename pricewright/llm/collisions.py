"""Nearest neighbours by counting collisions of single projections."""

from collections.abc import Iterator
from math import comb, sqrt
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .base import pieces_of, ship_package, stage

PROJECTIONS = 32
#: Collisions that make a candidate, and the chance that a neighbour reaches them.
THRESHOLD, CAUGHT = 13, 0.97
GROWTH = 2.0
BLOCK = 8192
#: Vectors of a band are no shorter than that share of its longest, unless the band would have fewer than so many.
NARROWER, LEAST_BAND = 0.8, 256


def reach(projections: int, threshold: int, caught: float) -> float:
    """Half a window, in distances of a vector from the query, at which the vector collides often enough with this chance."""

    def chance(p: float) -> float:
        return sum(comb(projections, i) * p**i * (1 - p) ** (projections - i) for i in range(threshold, projections + 1))

    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if chance(middle) >= caught else (middle, high)
    return NormalDist().inv_cdf(0.5 + high / 2)


class BlockIndex:
    """The vectors of a block, longest first, in bands of like length; each band has a sorted array per projection.

    One more component brings every vector of a band to the length of its longest; the query's is 0. Then the
    largest product is the smallest distance.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, seed: int, projections: int = PROJECTIONS, threshold: int = THRESHOLD, caught: float = CAUGHT):
        lengths = np.sqrt((vectors**2).sum(axis=1))
        by_length = np.argsort(-lengths, kind="stable")
        self.ids, self.vectors, lengths = ids[by_length], vectors[by_length], lengths[by_length]
        # Candidates are checked in single precision first, and those that may be among the best again in double.
        self.rough = self.vectors.astype(np.float32)
        self.threshold, self.factor = threshold, reach(projections, threshold, caught)
        n, dim = vectors.shape
        self.axes = np.random.default_rng([seed, dim]).normal(size=(dim + 1, projections))
        self.bands, first = [], 0
        while first < n:
            longest = lengths[first]
            stop = min(n, max(first + LEAST_BAND, int(np.searchsorted(-lengths, -NARROWER * longest))))
            lift = np.sqrt(np.maximum(longest**2 - lengths[first:stop]**2, 0.0))
            placed = self.vectors[first:stop] @ self.axes[:dim] + lift[:, None] * self.axes[dim]
            order = np.ascontiguousarray(np.argsort(placed, axis=0, kind="stable").T)
            self.bands.append((first, stop, longest, order, np.take_along_axis(placed.T, order, axis=1)))
            first = stop

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """The ids found nearest, their inner products, and how many vectors were verified.

        In each band windows around the query grow until a vector as far as the ``k``-th best found so far would have been
        caught; once no vector of a band can be as near as that, neither can any of those after it, and the search is over.
        """
        n, square, centre = len(self.ids), float((query**2).sum()), query @ self.axes[:-1]
        rough_query, scores, found = query.astype(np.float32), np.full(n, -np.inf, np.float32), 0
        kth = -np.inf
        for first, stop, longest, order, values in self.bands:
            slack = 1e-5 * longest * sqrt(square)
            if longest * sqrt(square) < kth - slack:
                break
            counts, verified = np.zeros(stop - first, np.int64), self.ids[first:stop] == query_id
            middle = [row.searchsorted(at) for row, at in zip(values, centre.tolist())]
            left, right = list(middle), list(middle)
            widest = max(abs(values[:, 0]).max(), abs(values[:, -1]).max()) + np.abs(centre).max()
            width = self.factor * 0.25 * sqrt(longest**2 + square)
            while True:
                parts = []
                for j, (row, at) in enumerate(zip(values, centre.tolist())):
                    low, high = row.searchsorted((at - width, at + width)).tolist()
                    parts += [order[j, low:left[j]], order[j, right[j]:high]]
                    left[j], right[j] = low, high
                counts += np.bincount(np.concatenate(parts), minlength=stop - first)
                new = np.flatnonzero((counts >= self.threshold) & ~verified)
                scores[first + new] = self.rough[first + new] @ rough_query
                verified[new] = True
                found += len(new)
                if width > widest:
                    break
                grown = width * GROWTH
                if found >= k:
                    kth = float(np.partition(scores, n - k)[n - k]) - slack
                    enough = self.factor * sqrt(max(longest**2 + square - 2 * kth, 0.0))
                    if width >= enough:
                        break
                    grown = min(grown, enough)
                width = grown
        best = np.flatnonzero(scores > -np.inf)
        if found > k:
            slack = 1e-5 * self.bands[0][2] * sqrt(square)
            best = np.flatnonzero(scores >= float(np.partition(scores, n - k)[n - k]) - 2 * slack)
        # Sums row by row, not a matrix product: equal vectors must get equal scores.
        exact = np.einsum("ij,j->i", self.vectors[best], query)
        nearest_first = np.lexsort((self.ids[best], -exact))[:k]
        return self.ids[best][nearest_first], exact[nearest_first], found


FOUND = ["query_id", "vec_id", "score"]


def _stream(k: int, seed: int):
    """Rows (dim, block, asks, id, v), blocks together and a block's vectors before its queries: each block is indexed once, and the queries pass by."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, index = None, [], None
        for batch in batches:
            keys = list(zip(batch.column("dim").to_pylist(), batch.column("block").to_pylist()))
            asks, ids = batch.column("asks").to_numpy(zero_copy_only=False), batch.column("id").to_numpy()
            edges = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1] or asks[i] != asks[i - 1]), len(keys)]
            for first, stop in zip(edges, edges[1:]):
                if first == stop:
                    continue
                if keys[first] != at:
                    at, held, index = keys[first], [], None
                vectors = batch.column("v").slice(first, stop - first).flatten().to_numpy(zero_copy_only=False).reshape(stop - first, -1)
                if not asks[first]:
                    held.append((ids[first:stop].copy(), vectors.copy()))
                    continue
                if index is None and held:
                    index, held = BlockIndex(*map(np.concatenate, zip(*held)), seed), []
                if index is None:
                    continue
                found = [index.search(query_id, query, k)[:2] for query_id, query in zip(ids[first:stop].tolist(), vectors)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(ids[first:stop], [len(rows) for rows, _ in found])),
                    pa.array(np.concatenate([rows for rows, _ in found])), pa.array(np.concatenate([scores for _, scores in found]))], names=FOUND)
    return run


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and v (doubles) of the rows that take part: an id, and a vector without null or non-finite components that is not zero."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where("vec_id is not null and v is not null").where(~bad & F.exists("v", lambda x: x != 0))


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 11) -> DataFrame:
    """The ``k`` nearest found of each query: query_id, rank, vec_id, score.

    Queries are rows whose id is a multiple of ``every``, candidates all rows with other
    ids; nearness is the inner product. Null ids and unusable vectors take no part, and vectors of
    other lengths than the query's are no candidates. Rows of one id are candidates each; as a query the smallest counts.

    Rows are dealt into blocks of about ``BLOCK``, each of which moves and is indexed once. All queries pass by
    every block, a batch at a time, so work grows with queries times rows, as the query set does. A block hands on ``k`` rows a query.
    """
    ship_package(vectors.sparkSession)
    base = stage(usable(vectors, id_col, vector_col).withColumn("dim", F.size("v")), "vectors")
    asked = base.where(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("query_id"), "dim").agg(F.min("v").alias("v"))
    asked = stage(asked.groupBy("query_id").agg(F.min(F.struct("v", "dim")).alias("q")).select("query_id", "q.*"), "queries")
    blocks = pieces_of(base.count(), BLOCK)
    left = base.select("dim", F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(blocks)).cast("long").alias("block"), F.lit(False).alias("asks"), F.col("vec_id").alias("id"), "v")
    every_block = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block")
    right = asked.select("dim", every_block, F.lit(True).alias("asks"), F.col("query_id").alias("id"), "v")
    rows = left.unionByName(right).repartition(blocks, "dim", "block").sortWithinPartitions("dim", "block", "asks")
    found = rows.mapInArrow(_stream(k, seed), "query_id long, vec_id long, score double")
    line = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(line)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
