"""k-means over integer vectors, each vector assigned by an annulus search over the sorted norms of the centroids.

A centroid within distance u of a vector has a norm within u of the vector's own (triangle inequality). Centroids are sorted by norm;
each vector takes the distance to the PILOTS centroids that stand next to its norm as its upper bound, a binary search gives the
centroids of that annulus, and these are compared exactly, in integers, boundary ties included. Every round reads the same
written table of scaled vectors; what leaves a task is one row of sums for each of the k clusters.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

DIMENSIONS = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
SEED = 2
#: Centroids next to a vector's norm whose least distance is its upper bound.
PILOTS = 4
#: Components up to this magnitude are compared in 64-bit integers; vectors with larger ones in Python's.
SMALL = 1 << 26
ROWS_AT_ONCE = 4096
MOST = (1 << 63) - 1


def scaled_vectors(table: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v array<long>) of the vectors that take part: floor(scale * x) of exactly ``dimensions`` finite components.

    A component that leaves a long once scaled cannot be written: its vector takes no part, like those with null or non-finite ones.
    """
    v = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale))
    fits = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < float(1 << 62)))
    return table.where(F.col(vector_col).isNotNull() & (F.size(vector_col) == dimensions) & fits).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The k vectors whose ``seed:vec_id`` has the smallest SHA-256, in this order; equal ids by their components, a null id as ``null``."""
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    return [list(r.v) for r in vectors.select("v", place.alias("place")).orderBy("place", "v").limit(k).collect()]


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to one centroid (int64 or Python integers, as the rows are)."""
    gap = x - c
    return (gap * gap).sum(axis=1)


def nearest(x: np.ndarray, centroids: np.ndarray, pilots: int = PILOTS) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of and squared distance to the nearest centroid of each row (ties: smaller number), and how many comparisons that took."""
    length = lambda a: np.sqrt((a.astype(np.float64) ** 2).sum(axis=1))
    norms = length(centroids)
    order = np.argsort(norms, kind="stable")
    norms, own, k = norms[order], length(x), len(centroids)
    best, number = np.full(len(x), -1, dtype=x.dtype), np.full(len(x), k, dtype=np.int64)

    def compare(rows: np.ndarray, at: int) -> None:
        found, j = squared(x[rows], centroids[order[at]]), int(order[at])
        closer = (number[rows] == k) | (found < best[rows]) | ((found == best[rows]) & (j < number[rows]))
        best[rows[closer]], number[rows[closer]] = found[closer], j

    # the upper bound: the least distance to the centroids whose norms are next to the vector's
    low = np.clip(np.searchsorted(norms, own) - pilots // 2, 0, max(k - pilots, 0))
    high, compared = np.minimum(low + pilots, k), 0
    for at in range(k):
        rows = np.flatnonzero((low <= at) & (at < high))
        if len(rows):
            compare(rows, at)
            compared += len(rows)
    # the annulus: norms within the bound; the slack is far above what square roots lose, so that ties at its edge stay inside
    bound = np.sqrt(best.astype(np.float64))
    slack = 1e-9 * (own + bound) + 1e-6
    first, last = np.searchsorted(norms, own - bound - slack, side="left"), np.searchsorted(norms, own + bound + slack, side="right")
    for at in range(k):
        rows = np.flatnonzero((first <= at) & (at < last) & ~((low <= at) & (at < high)))
        if len(rows):
            compare(rows, at)
            compared += len(rows)
    return number, best, compared


def _matrices(batch: pa.RecordBatch, dimensions: int):
    """(row numbers, matrix) of a batch: rows of small components as int64, others as Python integers."""
    values = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
    small = (np.abs(values) <= SMALL).all(axis=1)
    for at in range(0, len(values), ROWS_AT_ONCE):
        rows = at + np.flatnonzero(small[at : at + ROWS_AT_ONCE])
        if len(rows):
            yield rows, values[rows]
    large = np.flatnonzero(~small)
    if len(large):
        yield large, values[large].astype(object)


def _as(matrix: np.ndarray, centroids: list[list[int]]) -> np.ndarray:
    """The centroids in the rows' integers; small rows meet centroids that may have moved beyond SMALL."""
    wide = matrix.dtype == object or any(abs(x) > SMALL for c in centroids for x in c)
    return np.array(centroids, dtype=object if wide else np.int64)


def cluster_sums(vectors: DataFrame, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
    """cluster -> (rows, componentwise sums), each task's rows summed before anything is shuffled."""
    dimensions = len(centroids[0])

    def run(batches):
        counts, sums = [0] * len(centroids), [None] * len(centroids)
        for batch in batches:
            for _, x in _matrices(batch, dimensions):
                c = _as(x, centroids)
                number, _, _ = nearest(x.astype(c.dtype), c)
                for j in np.unique(number).tolist():
                    own = x[number == j]
                    counts[j] += len(own)
                    total = own.sum(axis=0).tolist()
                    sums[j] = total if sums[j] is None else [p + q for p, q in zip(sums[j], total, strict=True)]
        used = [j for j, n in enumerate(counts) if n]
        flat = pa.array([[Decimal(s) for s in sums[j]] for j in used], pa.list_(pa.decimal128(38, 0)))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([counts[j] for j in used], pa.int64()), flat], names=["cluster", "n", "sums"])

    parts = C.map_arrow(vectors.select("v"), run, "cluster int, n long, sums array<decimal(38,0)>")
    each = parts.select("cluster", "n", F.posexplode("sums").alias("i", "s")).groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    rows = sorted(each.collect(), key=lambda r: (r.cluster, r.i))  # k rows for each component
    return {j: (rows[at].n, [int(r.s) for r in rows[at : at + dimensions]]) for at, j in ((at, rows[at].cluster) for at in range(0, len(rows), dimensions))}


def assigned(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(vec_id, cluster, distance): the nearest centroid of every vector; a distance that leaves a long is null."""
    dimensions = len(centroids[0])

    def run(batches):
        for batch in batches:
            cluster, distance = np.zeros(batch.num_rows, np.int32), [0] * batch.num_rows
            for rows, x in _matrices(batch, dimensions):
                c = _as(x, centroids)
                number, best, _ = nearest(x.astype(c.dtype), c)
                cluster[rows] = number
                for at, d in zip(rows.tolist(), best.tolist(), strict=True):
                    distance[at] = d if d <= MOST else None
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"])

    return C.map_arrow(vectors, run, "vec_id long, cluster int, distance long")


def moved(centroids: list[list[int]], sums: dict[int, tuple[int, list[int]]]) -> list[list[int]]:
    """Every non-empty centroid at the exact floor of its mean; empty ones stay."""
    return [[s // sums[j][0] for s in sums[j][1]] if j in sums else c for j, c in enumerate(centroids)]


def centroid_clusters(
    table: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED, id_col: str = "vec_id", vector_col: str = "embedding"
) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) of every vector that takes part, and the centroids.

    Fewer than k vectors give as many centroids; none give an empty table and no centroids. Repeated rows and null ids count like any
    other row. Vectors that are null, of another length, or hold null or non-finite components are left out.
    """
    spark = table.sparkSession
    vectors = C.materialize(scaled_vectors(table, dimensions, scale, id_col, vector_col), "centroid-vectors")
    centroids = first_centroids(vectors, k, seed)
    if not centroids:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), []
    for _ in range(rounds):
        centroids = moved(centroids, cluster_sums(vectors, centroids))
    return C.materialize(assigned(vectors, centroids), "centroid-clusters"), centroids


def centroid_report(clusters: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """The clusters with cluster_inertia and inertia (sums of distance over the cluster and over all) and centroid_sha256.

    A sum that leaves a long, or holds a distance that does, is null.
    """
    spark = clusters.sparkSession
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    whole = lambda c: F.when(F.count("distance") == F.count(F.lit(1)), c)
    sums = {r.cluster: r.total for r in clusters.groupBy("cluster").agg(whole(total).alias("total")).collect()}  # k rows
    fits = lambda v: None if v is None or v > MOST else int(v)
    inertia = fits(sum(sums.values())) if None not in sums.values() else None
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    rows = [(j, fits(t), inertia, digest[j]) for j, t in sorted(sums.items())]
    report = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return clusters.join(F.broadcast(report), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # at most k rows
