"""Exact k-means over whole numbers, with bounds that save distance computations.

Each vector keeps its cluster, an upper bound of the distance to its centroid and a
lower bound of the distance to every other one. When the centroids have moved, the
upper bound grows by its centroid's drift. How far the lower bound must fall is
found by geometry: all vectors of a cluster lie in a sphere around its old centroid;
how much nearer another centroid can have come to any point of that sphere is a
problem in the plane through both places of that centroid and the sphere's centre.
The answer is mostly far below the full drift, and nothing for a centroid that moves
away from the sphere. Only vectors whose bounds then meet are looked at exactly.

With the two places a and b of the other centroid D apart, the distance to a less
that to b is, at a point u along a-b from their middle and at distance w from the
middle, 2uD / (distance to a + distance to b). The sum is at least 2w, and at least
D, so the difference is at most D u/w, the cosine of the angle seen from the middle,
and at most 2u. Over a sphere both are largest where the sphere comes nearest to the
line from a to b.

Distances are compared in whole numbers; bounds are doubles with a margin that is
far above their rounding, so a vector is never wrongly left alone.

At scale: a round is one pass over the vectors and their bounds, kept on the
executors; a task sends sums of its own, the driver holds k centroids and their sums.
Lost partitions are computed again from the vectors, which every step treats alike.

Edge cases: vectors of another length, with nulls, NaN or infinities are left out; a
vector without id counts, with the id "" for the choice of the first centroids;
equal ids are told apart by their components; fewer vectors than clusters make fewer
clusters; components beyond +-65,536.0 are set to it, so that a squared distance fits
64 bits; no vectors, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marklens.llm.storage import keep


@dataclass(frozen=True)
class Clustering:
    """k: clusters; rounds: assignments followed by an update; length: components of a
    vector; scale: factor before components are cut to whole numbers; seed: prefix of
    the ids whose digests choose the first centroids."""

    k: int = 8
    rounds: int = 10
    length: int = 64
    scale: int = 1024
    seed: str = "3:"


DEFAULT = Clustering()
LIMIT = 1 << 26

_VECTORS = "vec_id long, vector binary"
_STATE = "vec_id long, vector binary, cluster int, upper double, lower double"
_SUMS = "cluster int, component int, total long, radius double"
_RESULT = "vec_id long, cluster int, distance long"


def _whole(batches: Iterator[pa.RecordBatch], how: Clustering) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False)
        cut = np.clip(np.floor(flat.astype(np.float64) * how.scale), -LIMIT, LIMIT)
        rows = cut.astype("<i4").reshape(-1, how.length)
        vectors = pa.array([row.tobytes() for row in rows], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), vectors], ["vec_id", "vector"])


def whole_vectors(embeddings: DataFrame, how: Clustering = DEFAULT) -> DataFrame:
    """Vectors of the right length with finite components, as packed 32-bit numbers."""
    usable = (F.size("embedding") == how.length) & F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")),
    )
    rows = embeddings.filter(F.coalesce(usable, F.lit(False))).select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding")
    )
    return rows.mapInArrow(partial(_whole, how=how), _VECTORS)


def first_centroids(vectors: DataFrame, how: Clustering = DEFAULT) -> np.ndarray:
    """The k vectors with the smallest digests of their ids."""
    text = F.concat(F.lit(how.seed), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    chosen = vectors.orderBy(F.sha2(text, 256), "vector").limit(how.k).collect()
    return np.array([_numbers(row["vector"]) for row in chosen], np.int64).reshape(-1, how.length)


def _numbers(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "<i4").astype(np.int64)


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    """Packed vectors as rows; they lie one after another in the column's buffer."""
    _, offsets, data = column.buffers()
    start = np.frombuffer(offsets, np.int32)[column.offset]
    size = len(column) * length
    return np.frombuffer(data, "<i4", size, int(start)).reshape(-1, length).astype(np.int64)


def _squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    apart = vectors - centroids
    return np.einsum("ij,ij->i", apart, apart)


def _scanned(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, ...]:
    """Nearest centroid, the smaller number on a tie; its distance and the next one's."""
    every = np.stack([_squared(vectors, c) for c in centroids], axis=1)
    nearest = every.argmin(axis=1)
    best = every[np.arange(len(every)), nearest]
    every[np.arange(len(every)), nearest] = np.iinfo(np.int64).max
    return nearest.astype(np.int32), np.sqrt(best), np.sqrt(every.min(axis=1))


@dataclass(frozen=True)
class Move:
    """Centroids before and after an update, and the radius of each cluster's sphere
    around the old one; a cluster without vectors has radius -1."""

    before: np.ndarray
    after: np.ndarray
    radius: np.ndarray

    @property
    def margin(self) -> float:
        """Above what rounding can take from a bound."""
        largest = max(np.abs(self.before).max(), np.abs(self.after).max(), self.radius.max(), 1)
        return 1e-9 * float(largest) * self.before.shape[1] + 1e-6

    @property
    def drift(self) -> np.ndarray:
        return np.sqrt(((self.after - self.before).astype(float) ** 2).sum(axis=1))

    def nearer(self) -> np.ndarray:
        """For each cluster, how much nearer any other centroid can have come to a
        point of its sphere; never more than the largest drift, and often nothing."""
        return np.array([max([0.0, *self._from_others(i)]) for i in range(len(self.before))])

    def _from_others(self, i: int) -> Iterator[float]:
        centre, radius = self.before[i].astype(float), float(self.radius[i]) + self.margin
        for j, drift in enumerate(self.drift):
            if j == i or self.radius[i] < 0 or not drift:
                continue
            a, b = self.before[j].astype(float), self.after[j].astype(float)
            yield sphere_bound(centre, radius, a, b)


def sphere_bound(centre: np.ndarray, radius: float, a: np.ndarray, b: np.ndarray) -> float:
    """The most by which b can be nearer than a to a point of the sphere, or 0."""
    drift = float(np.linalg.norm(b - a))
    seen = centre - (a + b) / 2
    along, far = float(seen @ (b - a)) / drift, float(np.linalg.norm(seen))
    if along + radius <= 0:
        return 0.0
    if far <= radius:
        return min(drift, 2 * (along + radius))
    angle = np.arccos(np.clip(along / far, -1, 1)) - np.arcsin(radius / far)
    return max(0.0, min(drift * float(np.cos(max(angle, 0.0))), 2 * (along + radius)))


def _started(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            vectors = _matrix(batch.column("vector"), centroids.shape[1])
            yield _state(batch, *_scanned(vectors, centroids))


def _state(batch: pa.RecordBatch, cluster, upper, lower) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            batch.column("vec_id"),
            batch.column("vector"),
            pa.array(cluster, pa.int32()),
            pa.array(upper, pa.float64()),
            pa.array(lower, pa.float64()),
        ],
        ["vec_id", "vector", "cluster", "upper", "lower"],
    )


def _moved(batches: Iterator[pa.RecordBatch], move: Move) -> Iterator[pa.RecordBatch]:
    drift, nearer, margin = move.drift, move.nearer(), move.margin
    for batch in batches:
        if not batch.num_rows:
            continue
        vectors = _matrix(batch.column("vector"), move.after.shape[1])
        cluster = batch.column("cluster").to_numpy().copy()
        upper = batch.column("upper").to_numpy() + drift[cluster] + margin
        lower = batch.column("lower").to_numpy() - nearer[cluster] - margin
        unsure = np.flatnonzero(upper >= lower)
        upper[unsure] = np.sqrt(_squared(vectors[unsure], move.after[cluster[unsure]]))
        unsure = unsure[upper[unsure] + margin >= lower[unsure]]
        if len(unsure):
            cluster[unsure], upper[unsure], lower[unsure] = _scanned(vectors[unsure], move.after)
        yield _state(batch, cluster, upper, lower)


def _summed(batches: Iterator[pa.RecordBatch], k: int, length: int) -> Iterator[pa.RecordBatch]:
    """Of a task: each cluster's sums, its count as the component after the last, and
    the largest upper bound."""
    sums, radius = np.zeros((k, length + 1), np.int64), np.full(k, -1.0)
    for batch in batches:
        if not batch.num_rows:
            continue
        vectors, cluster = _matrix(batch.column("vector"), length), batch.column("cluster").to_numpy()
        for i in np.unique(cluster):
            own = cluster == i
            sums[i, :length] += vectors[own].sum(axis=0)
            sums[i, length] += own.sum()
        np.maximum.at(radius, cluster, batch.column("upper").to_numpy())
    some = np.flatnonzero(sums[:, length])
    at = np.tile(np.arange(length + 1, dtype=np.int32), len(some))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(some, length + 1).astype(np.int32)),
            pa.array(at),
            pa.array(sums[some].ravel()),
            pa.array(np.repeat(radius[some], length + 1)),
        ],
        ["cluster", "component", "total", "radius"],
    )


def _update(state: DataFrame, centroids: np.ndarray) -> Move:
    """Each centroid with vectors becomes the floor of their mean, exactly."""
    k, length = centroids.shape
    parts = state.mapInArrow(partial(_summed, k=k, length=length), _SUMS)
    total = F.sum(F.col("total").cast("decimal(38, 0)")).alias("total")
    rows = parts.groupBy("cluster", "component").agg(total, F.max("radius").alias("radius")).collect()
    totals = {(row["cluster"], row["component"]): int(row["total"]) for row in rows}
    radius = np.full(k, -1.0)
    after = centroids.copy()
    for row in rows:
        cluster, component = row["cluster"], row["component"]
        radius[cluster] = row["radius"]
        if component < length:
            after[cluster, component] = totals[cluster, component] // totals[cluster, length]
    return Move(centroids, after, radius)


def _distances(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            vectors = _matrix(batch.column("vector"), centroids.shape[1])
            apart = _squared(vectors, centroids[batch.column("cluster").to_numpy()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("cluster"), pa.array(apart)],
                ["vec_id", "cluster", "distance"],
            )


def cluster(embeddings: DataFrame, how: Clustering = DEFAULT) -> tuple[DataFrame, np.ndarray]:
    """Cluster and squared distance of every usable vector, and the final centroids."""
    vectors = keep(whole_vectors(embeddings, how), "cluster-vectors")
    centroids = first_centroids(vectors, how)
    if not len(centroids):
        return embeddings.sparkSession.createDataFrame([], _RESULT), centroids
    state = vectors.mapInArrow(partial(_started, centroids=centroids), _STATE)
    state = state.persist(StorageLevel.MEMORY_AND_DISK)
    for _ in range(how.rounds):
        move = _update(state, centroids)
        earlier, centroids = state, move.after
        state = earlier.mapInArrow(partial(_moved, move=move), _STATE)
        state = state.persist(StorageLevel.MEMORY_AND_DISK)
        state.count()
        earlier.unpersist()
    found = keep(state.mapInArrow(partial(_distances, centroids=centroids), _RESULT), "clusters")
    state.unpersist()
    return found, centroids


def report(embeddings: DataFrame, how: Clustering = DEFAULT) -> DataFrame:
    """Clusters with their inertia, that of all, and a digest of the final centroid."""
    found, centroids = cluster(embeddings, how)
    sums = {r["cluster"]: r["total"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    digests = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    # A row per cluster.
    known = [(i, sums.get(i, 0), sum(sums.values()), digest) for i, digest in enumerate(digests)]
    facts = embeddings.sparkSession.createDataFrame(
        known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return found.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
