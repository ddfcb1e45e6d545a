"""Centroid clustering of integer vectors by sort-means.

Each round every centroid orders the others by their distance from it. A vector is compared with its
centroid of the round before, then with the others in that centroid's order, and stops at the first
that is strictly beyond twice the vector's distance from it: by the triangle inequality neither that
one nor any later one can be nearer, nor as near. Squared distances are compared (four times the
squared distance), all in integers, so results and ties are exact and the same on every run.

A round is one pass over the vectors, which are written with their cluster (the scan of the next round
starts there), and one over what was written for sums of each cluster: k x dim rows a task, added up by
Spark. The driver holds k centroids, a parameter's worth, whatever the number of vectors.

Vectors without an id are clustered but start no centroid; rows that repeat an id or a vector are
vectors of their own. With fewer vectors than k there are fewer centroids; with none, cluster and
distance are null. Components so large that a squared distance passes 64 bits raise an error.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_map, batch


def integer_vectors(vectors: DataFrame, dim: int = 64, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v array<long>): floor(scale * x) of the vectors that have dim components, none of them null or non-finite."""
    v = F.col(vector_col).cast("array<double>")
    sound = (F.size(v) == dim) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(sound).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, lambda x: F.floor(x * scale)).alias("v"))


def _narrow(*arrays: np.ndarray) -> bool:
    """Whether four times any squared distance fits 64 bits."""
    return 16 * arrays[0].shape[1] * max(int(max(a.max(initial=0), -a.min(initial=0))) for a in arrays) ** 2 < 2**63


class Centers:
    """Centroids of a round, with the order of the others from each."""

    def __init__(self, centers: list[list[int]]):
        self.c = np.array(centers, dtype=object)
        self.narrow = _narrow(self.c)
        if self.narrow:
            self.c = self.c.astype(np.int64)
        k = len(centers)
        apart = ((self.c[:, None] - self.c[None]) ** 2).sum(2)
        others = [sorted((apart[i, j], j) for j in range(k) if j != i) for i in range(k)]
        self.order = np.array([[j for _, j in row] for row in others], np.int64).reshape(k, k - 1)
        self.apart = np.array([[d for d, _ in row] for row in others], apart.dtype).reshape(k, k - 1)

    def nearest(self, x: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(cluster, squared distance) of each row of x, and how many distances were computed; before: clusters to start from."""
        c, order, apart = self.c, self.order, self.apart
        if not (self.narrow and _narrow(x, c)):
            x, c, apart = (y.astype(object) for y in (x, c, apart))
        at, best = before.copy(), ((x - c[before]) ** 2).sum(1)
        within = np.zeros(len(x), np.int64)  # others to look at
        for i in np.unique(before):
            own = before == i
            within[own] = np.searchsorted(apart[i], 4 * best[own], side="right")
        live, computed = np.flatnonzero(within > 0), len(x)
        for j in range(order.shape[1]):
            live = live[within[live] > j]
            if not live.size:
                break
            other = order[before[live], j]
            d = ((x[live] - c[other]) ** 2).sum(1)
            computed += len(live)
            nearer = (d < best[live]) | ((d == best[live]) & (other < at[live]))
            at[live[nearer]], best[live[nearer]] = other[nearer], d[nearer]
        return at, best, computed


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _assigned(rows: DataFrame, centers: list[list[int]]) -> DataFrame:
    shared, dim = Centers(centers), len(centers[0])
    out = pa.schema([("vec_id", pa.int64()), ("v", pa.list_(pa.int64())), ("cluster", pa.int32()), ("distance", pa.int64())])

    def assign(batches):
        for b in batches:
            if b.num_rows:
                at, best, _ = shared.nearest(_matrix(b.column(1), dim), b.column(2).to_numpy(zero_copy_only=False).astype(np.int64))
                yield batch(out, [b.column(0), b.column(1).cast(pa.list_(pa.int64())), at.astype(np.int32), [int(d) for d in best]])

    return rows.select("vec_id", "v", "cluster").transform(arrow_map, assign, "vec_id long, v array<long>, cluster int, distance long")


def _moved(assigned: DataFrame, centers: list[list[int]]) -> list[list[int]]:
    """Floors of the clusters' means; a centroid without vectors stays."""
    k, dim = len(centers), len(centers[0])
    out = pa.schema([("cluster", pa.int32()), ("i", pa.int32()), ("s", pa.int64()), ("n", pa.int64())])

    def add(batches):
        sums, n = np.zeros((k, dim), object), np.zeros(k, np.int64)
        for b in batches:
            x, at = _matrix(b.column(0), dim), b.column(1).to_numpy(zero_copy_only=False)
            for i in np.unique(at):
                own = x[at == i]
                sums[i] += own.sum(0) if _narrow(own) else own.astype(object).sum(0)
                n[i] += len(own)
        full = np.flatnonzero(n)
        if full.size:
            yield batch(out, [np.repeat(full, dim).astype(np.int32), np.tile(np.arange(dim, dtype=np.int32), len(full)), [int(s) for s in sums[full].ravel()], np.repeat(n[full], dim)])

    parts = assigned.select("v", "cluster").transform(arrow_map, add, "cluster int, i int, s long, n long")
    centers = [list(c) for c in centers]
    for r in parts.groupBy("cluster", "i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).collect():
        centers[r.cluster][r.i] = int(r.s) // r.n
    return centers


def sort_means(vectors: DataFrame, first: Column, k: int = 40, rounds: int = 5) -> tuple[DataFrame, list[list[int]]]:
    """((vec_id, v, cluster, distance) of each vector, final centroids) for integer vectors as integer_vectors gives them.

    The k vectors with the smallest `first` (an expression over vec_id; null: never) are the first centroids, in that order.
    """
    scratch = Scratch(vectors.sparkSession, "clusters")
    rows = scratch.keep(vectors.select("vec_id", "v", F.lit(0).alias("cluster")), "vectors")
    starts = rows.select(first.alias("f"), "v").where("f is not null").orderBy("f", "v").limit(k).collect()
    centers = [list(r.v) for r in sorted(starts, key=lambda r: (r.f, r.v))]
    if not centers:
        return rows.select("vec_id", "v", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance")), []
    for step in range(rounds):
        rows = scratch.keep(_assigned(rows, centers), f"round{step}")
        scratch.drop(f"round{step - 1}" if step else "vectors")
        centers = _moved(rows, centers)
    last = scratch.keep(_assigned(rows, centers), "last")
    scratch.drop(f"round{rounds - 1}" if rounds else "vectors")
    return last, centers


def with_inertia(assigned: DataFrame, centers: list[list[int]]) -> DataFrame:
    """assigned, with cluster_inertia, inertia (sums of distance over the cluster and over all) and centroid_sha256."""
    if not centers:
        empty = {"cluster_inertia": F.lit(None).cast("long"), "inertia": F.lit(None).cast("long"), "centroid_sha256": F.lit(None).cast("string")}
        return assigned.withColumns(empty)
    sums = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    total = sum(sums.values())
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    each = assigned.sparkSession.createDataFrame([(i, sums.get(i, 0), total, d) for i, d in enumerate(digest)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(each), "cluster")  # k rows
