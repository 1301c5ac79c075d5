"""Centroid clustering with bounds that are loosened by the geometry of the moved centroids, exact in integers.

Each vector keeps an upper bound of the distance to its centroid and a lower
bound of the distance to each other one.  When centroids move, the upper bound
grows by the way of its own centroid.  For the lower bounds, all vectors of a
cluster lie in a sphere around the old centroid; seen from the middle between the
old and the new place of another centroid, the sphere spans a cone, and in the
plane of the way and the centre of the sphere the angle between the cone and
the way tells how much nearer that centroid can have come: the way times the
cosine of the angle, which is less than the whole way unless the middle is in the
sphere.  Only for vectors and centroids whose bounds then overlap is the
distance computed exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saltmarsh.session import shared_folder, stored

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
LARGEST = 1 << 27  # of a component: squared distances stay below 2**62
SLACK = 1e-6  # for the rounding of bounds, with a relative part of 1e-12

VECTORS = "vec_id long, parts array<long>"
STATE = "kind int, vec_id long, parts array<long>, cluster int, upper double, lower array<float>, scanned long, count long"


def quantised(embeddings: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE, column: str = "embedding") -> DataFrame:
    """``vec_id`` and ``parts``, the components as integers ``floor(scale * x)``.

    Vectors that are null, have another number of components, or hold a null or
    non-finite component are left out; so are those with a component whose
    integer is above ``LARGEST`` in size, as their squared distances fit no long.
    """

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("parts")
            right = lists.value_lengths().to_numpy(zero_copy_only=False) == dimensions  # null compares unequal
            named = batch.column("vec_id").filter(pa.array(right))
            flat = lists.filter(pa.array(right)).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
            with np.errstate(invalid="ignore", over="ignore"):
                scaled = np.floor(flat * float(scale))  # null is NaN
                good = (np.abs(scaled) <= LARGEST).all(axis=1)
            yield pa.RecordBatch.from_arrays(
                [named.filter(pa.array(good)), _lists(scaled[good].astype(np.int64), dimensions)], names=["vec_id", "parts"])

    plain = embeddings.select("vec_id", F.col(column).cast("array<double>").alias("parts"))
    return plain.mapInArrow(keep, VECTORS)


def _lists(rows: np.ndarray, dimensions: int) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * dimensions), pa.array(rows.ravel()))


def _matrix(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    return batch.column("parts").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = 1) -> np.ndarray:
    """The vectors with the smallest sha256 of ``<seed>:<vec_id>``, in ascending order; a null id counts as empty.

    Equal hashes go by the components.  Fewer vectors than ``clusters`` give so many centroids.
    """
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    found = vectors.orderBy(mark, "parts").limit(clusters).select("parts").collect()
    return np.array([r[0] for r in found], np.int64)


def squared(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all centroids, in slices of bounded size."""
    out = np.empty((len(rows), len(centroids)), np.int64)
    for c, centre in enumerate(centroids):
        for k in range(0, len(rows), 4096):
            gap = rows[k:k + 4096] - centre
            out[k:k + 4096, c] = np.einsum("ij,ij->i", gap, gap)
    return out


def nearer_by(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """At [i, j]: how much nearer, at most, centroid j can have come to a vector in the sphere of cluster i by its move.

    With m the middle of the move from a to b, D its length and u its direction,
    |x - a| - |x - b| = 2 D u(x - m) / (|x - a| + |x - b|), and the denominator is
    at least 2 |x - m|; so the gain is at most D times the cosine of the angle at m
    between x and u.  Over the sphere with centre c and radius r that angle is at
    least the angle of c less asin(r / |c - m|).
    """
    way = (new - old).astype(float)
    length = np.sqrt((way * way).sum(axis=1))
    out = np.zeros((len(old), len(old)))
    for j in np.flatnonzero(length > 0):
        centre = old - (old[j] + new[j]) / 2
        along = centre @ way[j] / length[j]
        far = np.sqrt((centre * centre).sum(axis=1))
        across = np.sqrt(np.maximum(far * far - along * along, 0))
        outside = far > radius * (1 + 1e-9) + 1e-9  # the middle is not in the sphere
        safe = np.where(outside, far, 1.0)
        sine = np.where(outside, np.minimum(radius / safe, 1), 1.0)
        angle = np.arctan2(across, along) - np.arcsin(sine)
        cosine = np.where(outside, np.cos(np.clip(angle, 0, np.pi)), 1.0)
        out[:, j] = length[j] * np.clip(cosine, 0, 1)
    return out


def _below(distance: np.ndarray) -> np.ndarray:
    """Single-precision lower bounds of distances."""
    return np.nextafter((distance * (1 - 1e-12) - SLACK).astype(np.float32), np.float32(-np.inf))


class Move:
    """The centroids of a round and what their move does to the bounds of each cluster."""

    def __init__(self, centroids: np.ndarray, before: np.ndarray | None, radius: np.ndarray | None) -> None:
        self.centroids = centroids
        if before is None or radius is None:
            return
        self.others_nearer = nearer_by(before, centroids, radius)
        self.own_farther = np.sqrt(((centroids - before).astype(float) ** 2).sum(axis=1))

    def scan(self, rows: np.ndarray):
        """Cluster and bounds from all distances, and how many these were."""
        every = squared(rows, self.centroids)
        cluster = every.argmin(axis=1).astype(np.int32)
        upper = np.sqrt(every[np.arange(len(rows)), cluster]) * (1 + 1e-12) + SLACK
        return cluster, upper, _below(np.sqrt(every)), every.size

    def assign(self, rows: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray):
        """New cluster and bounds of vectors, and how many distances were computed; ties go to the smaller number."""
        at = np.arange(len(rows))
        cluster, upper = cluster.copy(), upper * (1 + 1e-12) + self.own_farther[cluster] + SLACK
        lower = _below(lower.astype(float) - self.others_nearer[cluster])
        lower[at, cluster] = np.inf  # never held against its own upper bound
        unsure = np.flatnonzero((lower <= upper[:, None]).any(axis=1))
        part, own, low = rows[unsure], cluster[unsure], lower[unsure]
        gap = part - self.centroids[own]
        best = np.einsum("ij,ij->i", gap, gap)
        low[np.arange(len(own)), own] = np.inf
        first, exact, computed = own.copy(), best.copy(), len(unsure)
        for j, centre in enumerate(self.centroids):
            near = np.flatnonzero((low[:, j] <= np.sqrt(best) * (1 + 1e-12) + SLACK) & (first != j))
            gap = part[near] - centre
            found = np.einsum("ij,ij->i", gap, gap)
            computed += len(near)
            low[near, j] = _below(np.sqrt(found))
            closer = (found < best[near]) | (found == best[near]) & (j < own[near])
            best[near[closer]], own[near[closer]] = found[closer], j
        low[np.arange(len(own)), first] = _below(np.sqrt(exact))
        cluster[unsure], lower[unsure] = own, low
        upper[unsure] = np.sqrt(best) * (1 + 1e-12) + SLACK
        return cluster, upper, lower, computed


def _round(vectors: DataFrame, move: Move, first: bool, dimensions: int) -> DataFrame:
    """One assignment of all vectors, written to the shared folder with partial sums per task and cluster (``kind`` 1).

    The sums travel with the vectors they belong to, so a task that runs again
    after a lost executor counts once.
    """
    clusters = len(move.centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, count = np.zeros((clusters, dimensions), np.int64), np.zeros(clusters, np.int64)
        radius, scanned = np.zeros(clusters), 0
        for batch in batches:
            rows = _matrix(batch, dimensions)
            if first:
                cluster, upper, lower, computed = move.scan(rows)
            else:
                state = [batch.column(n).to_numpy(zero_copy_only=False) for n in ("cluster", "upper")]
                lower = batch.column("lower").flatten().to_numpy(zero_copy_only=False).reshape(-1, clusters)
                cluster, upper, lower, computed = move.assign(rows, *state, lower)
            scanned += computed
            for c in np.unique(cluster):
                own = cluster == c
                sums[c] += rows[own].sum(axis=0)
                count[c] += own.sum()
                radius[c] = max(radius[c], upper[own].max())
            n = len(rows)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.zeros(n, np.int32)), batch.column("vec_id"), batch.column("parts"), pa.array(cluster, pa.int32()),
                pa.array(upper), _lists(lower, clusters), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names=names)
        used = np.flatnonzero(count)
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([
            pa.array(np.ones(len(used), np.int32)), pa.array(np.full(len(used), task, np.int64)), _lists(sums[used], dimensions),
            pa.array(used.astype(np.int32)), pa.array(radius[used]), pa.nulls(len(used), pa.list_(pa.float32())),
            pa.array(np.where(np.arange(len(used)) == 0, scanned, 0).astype(np.int64)), pa.array(count[used])], names=names)

    names = ["kind", "vec_id", "parts", "cluster", "upper", "lower", "scanned", "count"]
    spark = vectors.sparkSession
    folder = shared_folder(spark, "drift-clusters")
    vectors.mapInArrow(assign, STATE).write.partitionBy("kind").parquet(folder)
    return spark.read.schema(STATE).parquet(folder)


def _sums(state: DataFrame, clusters: int, dimensions: int):
    """Sums, counts, radii and the number of computed distances: one row per component and cluster comes to the driver."""
    parts = state.where("kind = 1")
    whole = parts.groupBy("cluster").agg(F.sum("count").alias("count"), F.max("upper").alias("radius"), F.sum("scanned").alias("scanned"))
    sums, count, radius, scanned = np.zeros((clusters, dimensions), object), np.zeros(clusters, object), np.zeros(clusters), 0
    for r in whole.collect():
        count[r["cluster"]], radius[r["cluster"]] = r["count"], r["radius"]
        scanned += r["scanned"]
    each = parts.select("cluster", F.posexplode("parts").alias("place", "part")).groupBy("cluster", "place").agg(
        F.sum(F.col("part").cast("decimal(38,0)")).alias("sum"))
    for r in each.collect():
        sums[r["cluster"], r["place"]] = int(r["sum"])
    return sums, count, radius, scanned


class Clusters:
    """The last centroids, the state of all vectors, and how many distances each round computed exactly."""

    def __init__(self, centroids: np.ndarray, state: DataFrame | None, scanned: list[int]) -> None:
        self.centroids, self.state, self.scanned = centroids, state, scanned


def fit(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS) -> Clusters:
    """``rounds`` times assign and move, then assign once more.

    A centroid becomes the floor of the exact mean of its vectors; one without
    vectors stays.  Distance ties go to the smaller number.
    """
    vectors = stored(vectors, "vectors")
    centroids = first_centroids(vectors, clusters)
    if not len(centroids):
        return Clusters(centroids, None, [])
    state = _round(vectors, Move(centroids, None, None), True, dimensions)
    seen = []
    for _ in range(rounds):
        sums, count, radius, scanned = _sums(state, len(centroids), dimensions)
        seen.append(int(scanned))
        moved = centroids.copy()
        for c in np.flatnonzero(count):
            moved[c] = [int(x) // int(count[c]) for x in sums[c]]
        move = Move(moved, centroids, radius)
        state, centroids = _round(state.where("kind = 0"), move, False, dimensions), moved
    return Clusters(centroids, state, seen + [int(_sums(state, len(centroids), dimensions)[3])])


def cluster(embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS) -> DataFrame:
    """Per kept vector: ``vec_id``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    Repeated rows and ids are vectors of their own.  An empty table, or one
    without a kept vector, gives no rows; other columns are not read.
    """
    found = fit(quantised(embeddings, dimensions), clusters, rounds, dimensions)
    schema = "vec_id long, cluster int, distance long"
    spark = embeddings.sparkSession
    if found.state is None:
        return spark.createDataFrame([], f"{schema}, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = found.centroids

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gap = _matrix(batch, dimensions) - centroids[batch.column("cluster").to_numpy(zero_copy_only=False)]
            distance = pa.array(np.einsum("ij,ij->i", gap, gap), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("cluster"), distance], names=["vec_id", "cluster", "distance"])

    rows = stored(found.state.where("kind = 0").select("vec_id", "parts", "cluster").mapInArrow(measure, schema), "distances")
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    sums = {r["cluster"]: r["s"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # one row per cluster
    table = spark.createDataFrame(
        [(c, sums.get(c, 0), sum(sums.values()), d) for c, d in enumerate(digests)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
