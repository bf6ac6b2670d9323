"""Exact clustering around centroids by a tournament of bisectors.

The points that two centroids are equally far from form a plane.  Its whole-number normal
and threshold are worked out once for every pair of centroids, and the sign of one inner
product then says which of the two is nearer to a vector.  A vector's champion meets every
other centroid once, k - 1 tests in all; zero favours the smaller number.  Only the distance
to the winner is ever computed, at the end.

A round is one pass without a shuffle of vectors: every task sums up its own vectors per
centroid, and one row per centroid and component leaves it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.session import materialize

WIDTH = 64        # components of a vector
SCALE = 256       # a component x counts as floor(SCALE * x)
CENTROIDS = 40
ROUNDS = 5
SEED = 2          # goes into the hash that picks the first centroids
BLOCK = 4_096     # vectors that one pass of numpy works on
LONG = 1 << 63    # distances from here on have no place in a long
LIMB = 60         # bits of a part of a sum

_FIELDS = ("id long, cluster int, distance long, cluster_inertia long, inertia long, "
           "centroid_sha256 string")


def whole(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of every x; whole numbers of any size, as objects beyond 52 bits."""
    if not values.size or np.abs(values).max() < (1 << 52) / SCALE:
        return np.floor(SCALE * values).astype(np.int64)
    numbers = [int(x) * SCALE if abs(x) >= 1 << 53 else int(np.floor(SCALE * x))
               for x in values.ravel().tolist()]
    return np.array(numbers, object).reshape(values.shape)


def _largest(numbers: np.ndarray) -> int:
    return max(abs(int(numbers.min())), abs(int(numbers.max()))) if numbers.size else 0


class Bisectors:
    """Normals and thresholds for all pairs of centroids: k * k * width numbers."""

    def __init__(self, centroids: np.ndarray):
        exact = centroids.astype(object)
        lengths = (exact * exact).sum(axis=1)
        self.centroids = exact
        self.normals = 2 * (exact[None, :, :] - exact[:, None, :])
        self.thresholds = lengths[None, :] - lengths[:, None]
        self.size = max(_largest(self.normals), 1)
        self._as: dict = {}

    def _numbers(self, vectors: np.ndarray) -> tuple[type, np.ndarray, np.ndarray]:
        """A type in which the tests of these vectors are exact, and the pairs in it."""
        most = vectors.shape[1] * self.size * max(_largest(vectors), 1)
        most = max(most, _largest(self.thresholds)) * 2
        kind = np.float64 if most < 1 << 53 else np.int64 if most < LONG else object
        if kind not in self._as:
            self._as[kind] = self.normals.astype(kind), self.thresholds.astype(kind)
        return kind, *self._as[kind]

    def nearest(self, vectors: np.ndarray) -> np.ndarray:
        """The number of the nearest centroid of every vector, the smallest of equal ones."""
        kind, normals, thresholds = self._numbers(vectors)
        vectors = vectors.astype(kind)
        champion = np.zeros(len(vectors), np.int64)
        for rival in range(1, len(self.centroids)):
            plane = normals[champion, rival]
            plane *= vectors
            champion[plane.sum(axis=1) > thresholds[champion, rival]] = rival
        return champion

    def distances(self, vectors: np.ndarray, cluster: np.ndarray) -> list[int | None]:
        """Squared distance of every vector to its centroid; none where a long is too small."""
        size = _largest(vectors) + _largest(self.centroids)
        kind = np.int64 if vectors.shape[1] * size * size < LONG else object
        gaps = vectors.astype(kind) - self.centroids.astype(kind)[cluster]
        return [d if d < LONG else None for d in (gaps * gaps).sum(axis=1).tolist()]


def _blocks(batch: pa.RecordBatch, width: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, vectors) of runs of rows; every vector has ``width`` numbers."""
    for at in range(0, batch.num_rows, BLOCK):
        part = batch.slice(at, BLOCK)
        values = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        yield part.column(0), whole(values.reshape(part.num_rows, width))


def _limbs(number: int) -> Iterator[tuple[int, int]]:
    """(place, part) of a whole number: parts of LIMB bits, the last with the sign."""
    place = 0
    while not -(1 << 62) <= number < 1 << 62:
        yield place, number & ((1 << LIMB) - 1)
        number >>= LIMB
        place += 1
    yield place, number


def _summed(vectors: DataFrame, centroids: np.ndarray, width: int) -> list:
    """(cluster, component, sum) over all vectors; component -1 is their number."""
    planes = Bisectors(centroids)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(planes.centroids), width + 1), object)
        for batch in batches:
            for _, block in _blocks(batch, width):
                cluster = planes.nearest(block)
                order = np.argsort(cluster, kind="stable")
                own, first, n = np.unique(cluster[order], return_index=True, return_counts=True)
                sums[own, :width] += np.add.reduceat(block[order], first, axis=0).astype(object)
                sums[own, width] += n
        rows = [(c, i if i < width else -1, place, part) for c, i in zip(*np.nonzero(sums))
                for place, part in _limbs(int(sums[c, i]))]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(r[k]) for r in rows], pa.int64()) for k in range(4)],
                names=["cluster", "component", "place", "part"])

    found = (vectors.mapInArrow(add, "cluster long, component long, place long, part long")
             .groupBy("cluster", "component", "place")
             .agg(F.sum(F.col("part").cast("decimal(20,0)")).alias("part")).collect())
    sums: dict = {}
    for cluster, component, place, part in found:
        key = cluster, component
        sums[key] = sums.get(key, 0) + (int(part) << LIMB * place)
    return [(c, i, total) for (c, i), total in sums.items()]


def _moved(vectors: DataFrame, centroids: np.ndarray, width: int) -> np.ndarray:
    """Every centroid that has vectors, moved to their mean, rounded down."""
    sums = _summed(vectors, centroids, width)
    counts = {c: total for c, i, total in sums if i < 0}
    moved = centroids.copy()
    for c in counts:
        moved[c] = 0
    for c, i, total in sums:
        if i >= 0:
            moved[c, i] = total // counts[c]
    return moved


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, width: int = WIDTH,
            seed: int = SEED) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of ``vectors``.

    Takes (id long, vector array<double>), other columns are left alone.  Kept are vectors
    of exactly ``width`` components, none null or non-finite, each as floor(256 * x).  The
    first centroids are the ``k`` kept vectors with the smallest SHA-256 of ``seed:id``; of
    rows that repeat an id the smaller vector comes first, null ids come last and are
    assigned like others.  Fewer kept vectors give fewer centroids, none an empty result.
    Repeated rows count each.  Whole numbers of any size are exact; a distance or sum that
    a long cannot hold is null.  ``k`` bounds what tasks and the driver hold: k * k * width
    numbers.
    """
    spark = vectors.sparkSession
    sound = F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    kept = (vectors.select(F.col("id").cast("long").alias("id"),
                           F.col("vector").cast("array<double>").alias("vector"))
            .filter((F.size("vector") == width) & sound))
    print_ = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = kept.orderBy(print_.asc_nulls_last(), "vector").limit(k).select("vector").collect()
    if not first:
        return spark.createDataFrame([], _FIELDS)
    centroids = whole(np.array([r[0] for r in first], np.float64)).astype(object)
    for _ in range(rounds):
        centroids = _moved(kept, centroids, width)
    planes = Bisectors(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, block in _blocks(batch, width):
                own = planes.nearest(block)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(own.astype(np.int32)),
                     pa.array(planes.distances(block, own), pa.int64())],
                    names=["id", "cluster", "distance"])

    assigned = materialize(kept.mapInArrow(assign, "id long, cluster int, distance long"),
                           "assigned")
    exact = F.sum(F.col("distance").cast("decimal(20,0)"))
    sums = {r[0]: int(r[1]) if r[2] else None for r in assigned.groupBy("cluster").agg(
        exact, F.count("distance") == F.count("*")).collect()}
    whole_sum = None if None in sums.values() else sum(sums.values())

    def long(n: int | None) -> int | None:
        return None if n is None or n >= LONG else n

    texts = [",".join(map(str, c)) for c in centroids.tolist()]
    told = spark.createDataFrame(
        [(c, long(n), long(whole_sum), hashlib.sha256(texts[c].encode()).hexdigest())
         for c, n in sums.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row per centroid, so k rows are broadcast.
    return assigned.join(F.broadcast(told), "cluster").select(
        "id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sound vector's cluster after five rounds of forty centroids."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = cluster(vectors.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")))
    return found.withColumnRenamed("id", "vec_id")


def _assigned_sql(number: int) -> str:
    """SQL: each vector's nearest centroid of step ``number``, and the next centroids."""
    return f"""
near{number} AS (SELECT rid, min(list_sum(list_transform(list_zip(kept.v, c{number}.v),
    lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT * {CENTROIDS} + c) AS m
  FROM kept CROSS JOIN c{number} GROUP BY rid),
sums{number} AS (SELECT m % {CENTROIDS} AS c, i, sum(v[i])::BIGINT AS s, count(*) AS n
  FROM near{number} JOIN kept USING (rid) CROSS JOIN (SELECT unnest(range(1, {WIDTH + 1})) AS i)
  GROUP BY ALL),
means{number} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v
  FROM sums{number} GROUP BY c),
c{number + 1} AS (SELECT c, coalesce(means{number}.v, c{number}.v) AS v
  FROM c{number} LEFT JOIN means{number} USING (c)),"""


ORACLE_CLUSTERS = f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {WIDTH}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {WIDTH}),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), v) - 1 AS c, v FROM kept
  QUALIFY c < {CENTROIDS}),{"".join(map(_assigned_sql, range(ROUNDS + 1)))}
last AS (SELECT vec_id, (m % {CENTROIDS})::INTEGER AS cluster, m // {CENTROIDS} AS distance
  FROM near{ROUNDS} JOIN kept USING (rid))
SELECT vec_id, cluster, distance,
  (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
  (sum(distance) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c{ROUNDS}.v, ',')) AS centroid_sha256
FROM last JOIN c{ROUNDS} ON c = cluster
"""

QUERIES = {"op13_centroids": op13_centroids}
ORACLE = {"op13_centroids": ORACLE_CLUSTERS}
