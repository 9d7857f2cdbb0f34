"""Clustering around centroids; the nearest centroid is found by the threshold algorithm.

For each dimension the centroids are sorted by their value. From the value of a vector the lists are walked
outward, all dimensions in step; a centroid met for the first time is compared exactly. The distances of
the next entries of all lists, the frontier, bound what no list has shown yet: when the sum of their squares
exceeds the best distance strictly, no other centroid is as near, and ties have all been compared.

A round is one scan of the stored vectors: a task adds up its vectors per cluster, and only those sums (one
row per task and cluster) are shuffled. Vectors never move. The driver holds the centroids, `k` times
`dim` numbers; these are broadcast.

Components are integers, floor(scale * x), and all sums are exact. They must stay within 2 to the 27th, so
that 64 squared differences fit 64 bits; a larger one stops the job with its vec_id.

Defined results: vectors that are null, of another length, or hold null or non-finite components get no row.
Rows that repeat an id count as rows. Starting centroids go by the hash of the id, equal hashes by
components, rows without id come last. With fewer vectors than `k` each starts a centroid. Only vec_id and
embedding are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perkflow.llm.common import slices
from perkflow.sources.scratch import materialise

DIM = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
LIMIT = 1 << 27
_ROWS = 1024


def rows_of(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the lists of `dim` finite numbers, and these lists as a matrix."""
    at = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(column), dim), False).to_numpy(zero_copy_only=False))
    values = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    matrix = values.reshape(len(at), dim)
    good = np.isfinite(matrix).all(axis=1)
    return at[good], matrix[good]


def kept_vectors(vectors: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """vec_id and vec, the components as 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4 * _ROWS):
            at, matrix = rows_of(batch.column(1), dim)
            ids = batch.column(0).take(pa.array(at))
            large = np.flatnonzero((np.abs(matrix) > LIMIT / scale).any(axis=1))
            if len(large):
                raise ValueError(f"vec_id {ids[int(large[0])]}: a component exceeds {LIMIT / scale}")
            whole = np.floor(matrix * scale).astype("<i4")
            packed = pa.array([row.tobytes() for row in whole], pa.binary())
            yield pa.RecordBatch.from_arrays([ids, packed], names=["vec_id", "vec"])

    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return rows.mapInArrow(run, "vec_id long, vec binary")


def unpacked(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, dim).astype(np.int64)


class Lists:
    """The centroids and, per dimension, their numbers in the order of their values."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable")
        self.values = np.take_along_axis(centroids, self.order, axis=0)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each vector; ties to the smaller number."""
        k, dim = self.centroids.shape
        far = np.int64(2 * LIMIT)
        over, below = np.iinfo(np.int64).max, np.arange(dim)
        best, label = np.full(len(vectors), over), np.zeros(len(vectors), np.int64)
        live, seen = np.arange(len(vectors)), np.zeros((len(vectors), k), bool)
        up = np.stack([np.searchsorted(self.values[:, d], vectors[:, d]) for d in range(dim)], axis=1)
        down = up - 1
        while len(live):
            x = vectors[live]
            high, low = np.minimum(up, k - 1), np.maximum(down, 0)
            rise = np.where(up < k, self.values[high, below] - x, far)
            fall = np.where(down >= 0, x - self.values[low, below], far)
            frontier = np.minimum(rise, fall)
            more = ((frontier**2).sum(axis=1) <= best[live]) & ~seen.all(axis=1)
            if not more.all():
                live, seen, up, down, x = live[more], seen[more], up[more], down[more], x[more]
                high, low, rise, fall = high[more], low[more], rise[more], fall[more]
            upward = rise <= fall
            met = np.where(upward, self.order[high, below], self.order[low, below])
            up, down = up + upward, down - ~upward
            fresh = np.zeros_like(seen)
            np.put_along_axis(fresh, met, True, axis=1)
            fresh &= ~seen
            seen |= fresh
            row, number = np.nonzero(fresh)
            exact = np.full(seen.shape, over)
            exact[row, number] = ((x[row] - self.centroids[number]) ** 2).sum(axis=1)
            if not len(live):
                break
            nearest = exact.argmin(axis=1)
            distance = exact[np.arange(len(live)), nearest]
            old, old_label = best[live], label[live]
            better = (distance < old) | ((distance == old) & (nearest < old_label))
            best[live], label[live] = np.where(better, distance, old), np.where(better, nearest, old_label)
        return label, best


def first_centroids(table: DataFrame, k: int, dim: int, seed: str) -> np.ndarray:
    """The vectors whose ids hash lowest, at most `k`."""
    mark = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    rows = table.select(mark.alias("mark"), "vec").orderBy(F.asc_nulls_last("mark"), "vec").limit(k).collect()
    return np.frombuffer(b"".join(bytes(r.vec) for r in rows), "<i4").reshape(-1, dim).astype(np.int64)


def moved(table: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: the floors of the means; a centroid without vectors stays."""
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(centroids)
        n, sums = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in slices(batches, _ROWS):
            vectors = unpacked(batch.column(0), dim)
            label, _ = lists.nearest(vectors)
            n += np.bincount(label, minlength=k)
            np.add.at(sums, label, vectors)
        hit = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hit.astype(np.int32)), pa.array(n[hit]), pa.array(list(sums[hit]), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"],
        )

    parts = table.select("vec").mapInArrow(run, "cluster int, n long, sums array<long>")
    flat = parts.select("cluster", "n", F.posexplode("sums").alias("place", "part"))
    whole = flat.groupBy("cluster", "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total")
    )
    out = centroids.copy()
    for row in whole.collect():  # k times dim rows
        out[row.cluster, row.place] = int(row.total) // row.n
    return out


def assigned(table: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and distance of every stored vector."""
    dim = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(centroids)
        for batch in slices(batches, _ROWS):
            label, distance = lists.nearest(unpacked(batch.column(1), dim))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(label.astype(np.int32)), pa.array(distance)],
                names=["vec_id", "cluster", "distance"],
            )

    return table.select("vec_id", "vec").mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(
    vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: str = "1:",
) -> tuple[DataFrame, np.ndarray]:
    """Assignment of every usable vector after `rounds` rounds, and the final centroids."""
    table = materialise(kept_vectors(vectors, dim, scale), "whole_vectors")
    centroids = first_centroids(table, k, dim, seed)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long"), centroids
    for _ in range(rounds):
        centroids = moved(table, centroids)
    return materialise(assigned(table, centroids), "assigned"), centroids


def with_totals(spark: SparkSession, found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Assignments with the summed distance of their cluster and of all, and a digest of the centroid."""
    rows = found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()  # at most k
    total = sum(row.inertia for row in rows)
    facts = [
        (
            row.cluster, row.inertia, total,
            hashlib.sha256(",".join(map(str, centroids[row.cluster].tolist())).encode()).hexdigest(),
        )
        for row in rows
    ]
    table = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = found.join(table, "cluster")
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
