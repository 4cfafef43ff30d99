"""Centroid clustering with a pivot table.

Vectors are whole numbers: ``SCALE`` times each component, rounded down. Their distances to a few
fixed pivots are worked out once and stored beside them. In a round the distances of the centroids
to the pivots are all that is new: by the triangle inequality the largest difference of two
distances to one pivot bounds the distance of vector and centroid from below. A vector meets the
centroids in the order of these bounds, with exact integer distances, until the next bound is
beyond the best distance so far. Bounds are loosened by more than floating point can be off, so the
nearest centroid is never passed over; of equally near ones the smallest number counts.

A round adds up vectors by cluster within each task; one row per cluster, component and task is
shuffled, and only ``k * (dimensions + 1)`` sums reach the driver. The pivots are drawn from the
``POOL`` vectors that come first by hash: they decide how much is spared, never a result.

Vectors that are null, of another length, or with a null or non-finite component are left out. A
null id is never a first centroid before all others; rows with equal ids are vectors of their own,
and stand in the order of their components where their hashes tie. With fewer than ``k`` vectors
each is a centroid; an empty table gives no rows. A component beyond ``LARGEST`` after scaling
raises OverflowError, since squared distances would not fit a long. Only the id and vector columns
are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import kept

DIMENSIONS = 64
SCALE = 64.0
CLUSTERS = 16
ROUNDS = 3
PIVOTS = 8
POOL = 256
LARGEST = 1 << 27
SLACK = 1e-5  # distances reach 2^31, whose roots are off by less than 1e-6
PLACED = "vec_id long, cluster int, distance long, n_exact int"


def usable(vector: Column, dimensions: int = DIMENSIONS) -> Column:
    """Whether a vector has ``dimensions`` components, all of them finite numbers."""
    x = vector.cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce((F.size(x) == dimensions) & ~bad, F.lit(False))


def scaled(column: pa.Array, dimensions: int, scale: float = SCALE) -> np.ndarray:
    """The rows of a column of vectors as whole numbers."""
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    whole = np.floor(flat * scale)
    if len(whole) and np.abs(whole).max() > LARGEST:
        raise OverflowError(f"a component is beyond {LARGEST} after scaling")
    return whole.astype(np.int64).reshape(-1, dimensions)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of ``a`` and ``b``."""
    apart = a - b
    return np.einsum("ij,ij->i", apart, apart)


def roots(vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
    """The distance of each vector to each point."""
    if not len(points):
        return np.zeros((len(vectors), 0))
    return np.sqrt(np.column_stack([squared(vectors, p[None, :]) for p in points]).astype(np.float64))


def far_apart(pool: np.ndarray, n: int) -> np.ndarray:
    """``n`` vectors of a pool, each the farthest from those before it."""
    if not len(pool):
        return pool
    nearest = squared(pool, pool[:1])
    chosen = [int(nearest.argmax())]
    nearest = squared(pool, pool[chosen[0]][None, :])
    while len(chosen) < min(n, len(pool)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(pool, pool[chosen[-1]][None, :]))
    return pool[chosen]


def nearest(vectors: np.ndarray, table: np.ndarray, centroids: np.ndarray, to_pivots: np.ndarray) -> tuple[np.ndarray, ...]:
    """(cluster, squared distance, exact distances worked out) of each vector."""
    n, k = len(vectors), len(centroids)
    bound = np.zeros((n, k))
    for p in range(table.shape[1]):
        np.maximum(bound, np.abs(table[:, p, None] - to_pivots[None, :, p]), out=bound)
    bound -= SLACK
    order = np.argsort(bound, axis=1, kind="stable")
    bound = np.square(np.maximum(np.take_along_axis(bound, order, axis=1), 0)) * (1 - 1e-9)
    cluster = np.zeros(n, np.int32)
    best = np.full(n, np.iinfo(np.int64).max)
    counted = np.zeros(n, np.int32)
    open_rows = np.arange(n)
    for step in range(k):
        open_rows = open_rows[bound[open_rows, step] <= best[open_rows]]
        if not len(open_rows):
            break
        met = order[open_rows, step]
        d = squared(vectors[open_rows], centroids[met])
        counted[open_rows] += 1
        better = (d < best[open_rows]) | ((d == best[open_rows]) & (met < cluster[open_rows]))
        rows = open_rows[better]
        best[rows], cluster[rows] = d[better], met[better]
    return cluster, best, counted


@dataclass
class PivotTable:
    """The stored vectors with their distances to the pivots, and the first centroids."""

    rows: DataFrame
    pivots: np.ndarray
    seeds: np.ndarray
    dimensions: int

    def _read(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        of = lambda c, kind: np.frombuffer(b"".join(batch.column(c).to_pylist()), kind)
        vectors = of("vector", "<i4").astype(np.int64).reshape(-1, self.dimensions)
        return vectors, of("to_pivots", "<f8").reshape(len(vectors), len(self.pivots))

    def assign(self, centroids: np.ndarray) -> DataFrame:
        """(vec_id, cluster, distance, n_exact) of every vector."""
        near, read = roots(centroids, self.pivots), self._reader()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cluster, d, counted = nearest(*read(batch), centroids, near)
                yield pa.record_batch([batch.column("vec_id"), pa.array(cluster), pa.array(d), pa.array(counted)], ["vec_id", "cluster", "distance", "n_exact"])

        return self.rows.mapInArrow(run, PLACED)

    def _reader(self):
        light = PivotTable(None, self.pivots, self.seeds, self.dimensions)
        return light._read

    def moved(self, centroids: np.ndarray) -> np.ndarray:
        """The centroids after a round: the rounded down mean of their vectors, if any."""
        near, read, width = roots(centroids, self.pivots), self._reader(), self.dimensions
        k = len(centroids)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((k, width + 1), np.int64)
            for batch in batches:
                vectors, table = read(batch)
                cluster, _, _ = nearest(vectors, table, centroids, near)
                for c in np.unique(cluster).tolist():
                    mine = vectors[cluster == c]
                    sums[c, :width] += mine.sum(axis=0)
                    sums[c, width] += len(mine)
            c, place = np.nonzero(sums)
            columns = [pa.array(c.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(sums[c, place])]
            yield pa.record_batch(columns, ["cluster", "place", "total"])

        parts = self.rows.mapInArrow(run, "cluster int, place int, total long")
        totals = parts.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        sums = [[0] * (width + 1) for _ in range(k)]
        for row in totals.collect():  # k * (dimensions + 1) rows at most
            sums[row["cluster"]][row["place"]] = int(row["total"])
        out = centroids.copy()
        for c, (*whole, n) in enumerate(sums):
            if n:
                out[c] = [s // n for s in whole]
        return out


def pivot_table(vectors: DataFrame, k: int = CLUSTERS, pivots: int = PIVOTS, dimensions: int = DIMENSIONS) -> PivotTable:
    """The usable rows of (vec_id, embedding), stored with their distances to pivots."""
    good = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(usable(F.col("embedding"), dimensions))
    draw = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    first = good.select(draw.alias("draw"), "embedding").orderBy(F.asc_nulls_last("draw"), "embedding").limit(max(POOL, k)).collect()
    pool = scaled(pa.array([r["embedding"] for r in first], pa.list_(pa.float64())), dimensions)
    points = far_apart(pool, pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = scaled(batch.column("embedding"), dimensions)
            stored, near = whole.astype("<i4"), roots(whole, points).astype("<f8")
            yield pa.record_batch(
                [batch.column("vec_id"), pa.array([v.tobytes() for v in stored], pa.binary()), pa.array([d.tobytes() for d in near], pa.binary())],
                ["vec_id", "vector", "to_pivots"],
            )

    rows = kept(good.mapInArrow(run, "vec_id long, vector binary, to_pivots binary"), "pivot-table")
    return PivotTable(rows, points, pool[:k], dimensions)


def clusters(
    vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, pivots: int = PIVOTS, dimensions: int = DIMENSIONS
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, n_exact) of every usable vector.

    ``n_exact``: how many of the ``k`` distances of the last assignment had to be worked out.
    """
    spark = vectors.sparkSession
    table = pivot_table(vectors, k, pivots, dimensions)
    centroids = table.seeds
    for _ in range(rounds if len(centroids) else 0):
        centroids = table.moved(centroids)
    placed = kept(table.assign(centroids), "assigned")
    found = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()  # k rows
    whole = sum(int(r["total"]) for r in found)
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    known = [(r["cluster"], int(r["total"]), whole, names[r["cluster"]]) for r in found]
    facts = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "n_exact"
    )
