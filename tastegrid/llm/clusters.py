"""Centroid clustering of integer vectors, with centroids filtered by n-simplex projection before exact distances.

Components are scaled and floored to integers, so that distances and means are exact and the result does not depend on how rows
are dealt. A few pivots span a simplex. A vector's distances to them are computed once and stored as its apex: the coordinates at
which a further vertex with these distances would stand, its height over the simplex last. For two vectors the distance of their
apexes is a lower bound of theirs, and with one height turned to the other side an upper bound. In every round a centroid whose lower
bound exceeds the least upper bound, or the distance of the centroid that looks nearest, cannot be nearest itself; the rest are compared in
integers, ties going to the smaller number.

Tasks add up their rows per centroid, so one row per task, centroid and component is shuffled however the vectors are
distributed, and a vector that makes up a third of the table is arithmetic only. The driver holds the centroids.

Defined cases: a vector that is null, has another length, or a null, NaN or infinite component is left out; a null id counts
as the empty string in the choice of the first centroids; repeated ids are rows of their own, ties in the hash go to the smaller
vector. Fewer kept vectors than centroids give as many centroids as vectors. An empty table gives an empty result. A
component of 2**27 or more after scaling raises an error, as squared distances would leave 64 bits. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.session import materialize

PIVOTS = 32
LARGEST = 1 << 27
EXACT = 1 << 18  # components of candidate pairs compared at once


@dataclass(frozen=True)
class Simplex:
    """Pivots and the lower triangular matrix of their coordinates, the first one at the origin."""

    pivots: np.ndarray   # p x dims, integers
    base: np.ndarray     # (p - 1) x (p - 1)

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """n x p: coordinates in the pivots' space and the height over it, from the distances to the pivots alone."""
        if not len(self.pivots):
            return np.zeros((len(vectors), 0))
        squares = np.stack([squared(vectors, p) for p in self.pivots], axis=1).astype(np.float64)
        right = (squares[:, :1] + (self.base**2).sum(axis=1) - squares[:, 1:]) / 2
        flat = np.zeros_like(right)
        for i in range(len(self.base)):
            flat[:, i] = (right[:, i] - flat[:, :i] @ self.base[i, :i]) / self.base[i, i]
        height = np.sqrt(np.maximum(squares[:, 0] - (flat**2).sum(axis=1), 0))
        return np.concatenate((flat, height[:, None]), axis=1)


def squared(vectors: np.ndarray, other: np.ndarray) -> np.ndarray:
    difference = vectors - other
    return np.einsum("ij,ij->i", difference, difference)


def span_simplex(candidates: np.ndarray, most: int = PIVOTS) -> Simplex:
    """Pivots among the candidates: each time the one highest over those before, while any is clearly above them."""
    if not len(candidates):
        return Simplex(candidates, np.zeros((0, 0)))
    chosen, found = [0], Simplex(candidates[:1], np.zeros((0, 0)))
    scale = float(max(squared(candidates, candidates[0]).max(), 1))
    while len(chosen) < most:
        apex = found.apexes(candidates)
        highest = int(apex[:, -1].argmax())
        if apex[highest, -1] ** 2 < 1e-4 * scale:
            break
        size = len(chosen)
        base = np.zeros((size, size))
        base[:size - 1, :size - 1] = found.base
        base[size - 1] = apex[highest]
        chosen.append(highest)
        found = Simplex(candidates[chosen], base)
    return found


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, simplex: Simplex) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance) of every vector, and how many pairs were compared exactly."""
    if not len(vectors):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    own = simplex.apexes(centroids)
    flat = ((apexes[:, :-1] ** 2).sum(axis=1)[:, None] + (own[:, :-1] ** 2).sum(axis=1) - 2 * apexes[:, :-1] @ own[:, :-1].T)
    lower = flat + (apexes[:, -1:] - own[:, -1]) ** 2
    upper = (flat + (apexes[:, -1:] + own[:, -1]) ** 2).min(axis=1)
    # Bounds are doubles: what rounding could move is far below this share of the distances to the first pivot.
    slack = 1e-6 * ((apexes**2).sum(axis=1)[:, None] + (own**2).sum(axis=1)) + 1e-3
    # The centroid that looks nearest is compared first: its distance bounds the others as well.
    bound = np.minimum(upper, squared(vectors, centroids[lower.argmin(axis=1)]))
    row, column = np.nonzero(lower <= bound[:, None] + slack)
    distance = np.empty(len(row), np.int64)
    step = max(1, EXACT // max(1, vectors.shape[1]))
    for i in range(0, len(row), step):
        part = slice(i, i + step)
        distance[part] = squared(vectors[row[part]], centroids[column[part]])
    first = np.searchsorted(row, np.arange(len(vectors)))
    least = np.minimum.reduceat(distance, first)
    hit = np.flatnonzero(distance == least[row])
    at = hit[np.searchsorted(row[hit], np.arange(len(vectors)))]  # the smallest number among equal distances
    return column[at], least, len(row)


def _matrix(column, width: int, dtype) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype).reshape(len(column), width)


def integer_vectors(vectors: DataFrame, dims: int, scale: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(_id, _v): kept vectors as integer components floor(scale * x)."""
    v = F.col("_x")
    kept = vectors.select(F.col(id_col).cast("bigint").alias("_id"), F.col(vector_col).cast("array<double>").alias("_x")).filter(
        (F.size(v) == dims) & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))))
    whole = F.transform(v, lambda x: F.when(F.abs(x) * scale < LARGEST, F.floor(x * scale)).otherwise(
        F.raise_error(F.lit(f"a component is {LARGEST} or more after scaling; distances would not fit 64 bits")).cast("bigint")).cast("int"))
    return kept.select("_id", whole.alias("_v"))


def first_centroids(table: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest SHA-256 of ``seed:id``, in that order."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))), 256)
    rows = table.select("_v", digest.alias("_h")).orderBy("_h", "_v").limit(k).collect()
    return np.array([r["_v"] for r in rows], np.int64)


def with_apexes(table: DataFrame, simplex: Simplex, dims: int) -> DataFrame:
    """(_id, _v, _apex): the distances to the pivots, computed once for all rounds."""
    def run(batches):
        for batch in batches:
            apex = simplex.apexes(_matrix(batch.column(1), dims, np.int64))
            offsets = pa.array(np.arange(len(apex) + 1, dtype=np.int32) * apex.shape[1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(apex.ravel()))], ["_id", "_v", "_apex"])

    return table.mapInArrow(run, "_id bigint, _v array<int>, _apex array<double>")


def _batches(batches, simplex: Simplex, dims: int):
    width = len(simplex.pivots)
    for batch in batches:
        if batch.num_rows:
            yield batch, _matrix(batch.column("_v"), dims, np.int64), _matrix(batch.column("_apex"), width, np.float64)


def moved(table: DataFrame, centroids: np.ndarray, simplex: Simplex) -> np.ndarray:
    """The centroids after one round: floored exact means of their vectors; one without vectors stays."""
    k, dims = centroids.shape

    def run(batches):
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, vectors, apexes in _batches(batches, simplex, dims):
            cluster = nearest(vectors, apexes, centroids, simplex)[0]
            order = np.argsort(cluster, kind="stable")
            used, first = np.unique(cluster[order], return_index=True)
            sums[used] += np.add.reduceat(vectors[order], first, axis=0)
            counts += np.bincount(cluster, minlength=k)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used]), pa.array(sums[used].tolist(), pa.list_(pa.int64()))],
                                         ["cluster", "n", "sums"])

    parts = table.mapInArrow(run, "cluster bigint, n bigint, sums array<bigint>")
    rows = parts.select("cluster", "n", F.posexplode("sums").alias("place", "value")).groupBy("cluster", "place").agg(
        F.sum("value").alias("total"), F.sum("n").alias("n")).collect()  # at most centroids x components
    out = centroids.copy()
    for r in rows:
        out[r.cluster, r.place] = r.total // r.n
    return out


def assigned(table: DataFrame, centroids: np.ndarray, simplex: Simplex) -> DataFrame:
    """(_id, cluster, distance) of every vector."""
    dims = centroids.shape[1]

    def run(batches):
        for batch, vectors, apexes in _batches(batches, simplex, dims):
            cluster, distance, _ = nearest(vectors, apexes, centroids, simplex)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                                             ["_id", "cluster", "distance"])

    return table.mapInArrow(run, "_id bigint, cluster int, distance bigint")


def cluster_vectors(vectors: DataFrame, *, dims: int, k: int, rounds: int, seed: int, scale: int = 256, pivots: int = PIVOTS,
                    id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Every kept vector's id, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia`` and ``centroid_sha256``."""
    spark = vectors.sparkSession
    whole = integer_vectors(vectors, dims, scale, id_col, vector_col)
    centroids = first_centroids(whole, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], f"{id_col} bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, "
                                         "centroid_sha256 string")
    simplex = span_simplex(centroids, pivots)
    table = materialize(with_apexes(whole, simplex, dims))
    for _ in range(rounds):
        centroids = moved(table, centroids, simplex)
    found = materialize(assigned(table, centroids, simplex))
    inertia = {r.cluster: r.total for r in found.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    facts = spark.createDataFrame([(c, t, sum(inertia.values()), digests[c]) for c, t in inertia.items()],
                                  "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select(
        F.col("_id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
