"""Centroid clustering of integer vectors, with nearest centroids found by the threshold algorithm.

The centroids are few, so they go to every task. For each dimension they stand in a list sorted by
that component. From the place of a vector's own value each list is walked outward, nearer side
first. A centroid met in any list is compared exactly, once. The distances of the lists' frontiers,
squared and summed, bound what no list has shown yet: when that sum is strictly above the best
exact distance, nothing unseen is as near, not even as a tie, and the walk ends.

A task walks many vectors side by side and gives its sums by (centroid, dimension); the driver gets
k x dimensions sums a round, whatever the number of vectors. Vectors are scaled once and kept as a
table in the shared folder, so every round, and every task done again, starts from there.

Defined cases: vectors that are null, of another length, or with a component that is null, infinite
or not a number are left out; rows with one id are clustered each; a row without an id is clustered
but never a first centroid; starts with equal hashes stand in the order of their components; fewer
vectors than k give as many centroids; an empty table gives no rows. A component of more than 2^19
is an error, since squared distances would no longer fit 64 bits; so is a sum that does not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import staged

K, ROUNDS, DIMENSIONS, SCALE, SEED = 40, 5, 64, 256, 2
#: Largest component, and vectors that are walked side by side.
MOST, BLOCK = 2.0**19, 512
_FAR = np.int64(2**62)


def scaled(embeddings: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id and v, the integers floor(scale * x), of the vectors that are whole."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    whole = (F.size("embedding") == dimensions) & F.forall(
        "embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))
    )
    fits = F.forall("embedding", lambda e: F.abs(e) <= MOST)
    checked = F.when(fits, x).otherwise(F.raise_error(F.lit("a component is too large")))
    rows = embeddings.select("vec_id", "embedding").where(F.coalesce(whole, F.lit(False)))
    return rows.select("vec_id", F.transform(checked, lambda e: F.floor(e * scale)).alias("v"))


def first_centroids(vectors: DataFrame, k: int = K, seed: int = SEED) -> np.ndarray:
    """The k vectors whose ids have the smallest hashes, in that order."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.where("vec_id is not null").orderBy(mark, "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


class Lists:
    """The centroids in a sorted list for each dimension."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(centroids.T, self.order, axis=1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each row; the smaller number of equals."""
        (k, d), n = self.centroids.shape, len(x)
        dims = np.arange(d)
        right = np.stack([np.searchsorted(self.values[j], x[:, j]) for j in dims], axis=1) if n else np.zeros((0, d), np.int64)
        left = right - 1
        exact = np.full((n, k), _FAR)
        walking = np.arange(n)
        while len(walking):
            own, lo, hi = x[walking], left[walking], right[walking]
            below = np.where(lo >= 0, own - self.values[dims, np.maximum(lo, 0)], _FAR)
            above = np.where(hi < k, self.values[dims, np.minimum(hi, k - 1)] - own, _FAR)
            down = below <= above
            met = self.order[dims, np.where(down, lo, hi)]
            left[walking], right[walking] = lo - down, hi + ~down
            fresh = np.zeros((len(walking), k), bool)
            fresh[np.arange(len(walking))[:, None], met] = True
            row, number = np.nonzero(fresh & (exact[walking] == _FAR))
            exact[walking[row], number] = ((own[row] - self.centroids[number]) ** 2).sum(axis=1)
            found = exact[walking]
            frontier = (np.minimum(below, above) ** 2).sum(axis=1)
            walking = walking[(frontier <= found.min(axis=1)) & (found == _FAR).any(axis=1)]
        return exact.argmin(axis=1), exact.min(axis=1)


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and distance of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(centroids)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                number, distance = lists.nearest(_matrix(part.column("v"), centroids.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"]
                )

    return vectors.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid at the floor of the mean of its vectors; without vectors it stays."""
    k, d = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, total, count = Lists(centroids), np.zeros((k, d), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                x = _matrix(batch.slice(at, BLOCK).column("v"), d)
                number, _ = lists.nearest(x)
                np.add.at(total, number, x)
                count += np.bincount(number, minlength=k)
        held = np.flatnonzero(count)
        columns = [np.repeat(held, d), np.tile(np.arange(d), len(held)), total[held].ravel(), np.repeat(count[held], d)]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["number", "dimension", "total", "n"])

    parts = vectors.mapInArrow(run, "number bigint, dimension bigint, total bigint, n bigint")
    out = centroids.copy()
    for r in parts.groupBy("number", "dimension").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        out[r["number"], r["dimension"]] = r["total"] // r["n"]
    return out


def cluster(
    embeddings: DataFrame, k: int = K, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED
) -> tuple[DataFrame, np.ndarray]:
    """Assignments (vec_id, cluster, distance), and the centroids they belong to."""
    vectors = staged(scaled(embeddings, dimensions, scale), "vectors")
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        if not vectors.isEmpty():
            raise ValueError("no vector has an id, so there is no first centroid")
        return vectors.selectExpr("vec_id", "0 as cluster", "0L as distance"), centroids
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    return staged(assigned(vectors, centroids), "assigned"), centroids


def with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Assignments with the summed distance of their cluster and of all, and the hash of their centroid."""
    sums = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # a row per centroid
    inertia = sum(sums.values())
    rows = [
        (i, sums.get(i, 0), inertia, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())
    ]
    facts = found.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", *facts.columns[1:])
