"""Centroid clustering with a table of distances to pivots (LAESA).

The distances of every vector to a few fixed pivots are computed once and
stored with it.  In each round the centroids' distances to the pivots are
known, and their differences to a vector's bound its distance to every
centroid from below; only centroids whose bound does not exceed the distance
to the most promising one are compared exactly, in integers.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import column, materialise, ship_package

# Exact sums of squares of 64 differences stay below 2^63.
LARGEST = 1 << 27
# Relative error of a distance in floating point, with room.
SLACK = 1e-9
ROWS_AT_ONCE = 4096


@dataclass(frozen=True)
class ClusterParams:
    """``k`` centroids, ``rounds`` of moving them; vectors of ``dimension``
    components are scaled by ``scale`` and rounded down.  ``seed`` is hashed
    with the vector's id to choose the first centroids; ``pivots`` of them,
    far from each other, are the pivots."""
    k: int = 40
    rounds: int = 5
    dimension: int = 64
    scale: int = 256
    seed: str = "2:"
    pivots: int = 12


def integer_vectors(vectors: DataFrame, params: ClusterParams, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): the vectors of the right length without null, infinite and
    NaN components, scaled and rounded down."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    fine = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where((F.size("x") == params.dimension) & fine)
    scaled = F.transform("x", lambda x: F.floor(x * params.scale))
    small = F.forall("x", lambda x: F.abs(x) * params.scale < LARGEST)
    checked = F.when(small, scaled).otherwise(F.raise_error(F.lit(f"a scaled component is {LARGEST} or more")).cast("array<bigint>"))
    return rows.select("id", F.transform(checked, lambda x: x.cast("int")).alias("v"))


def first_centroids(rows: DataFrame, params: ClusterParams) -> np.ndarray:
    """The vectors of least SHA-256 of seed and id, in that order; of rows
    that share an id the lesser vector first.  At most ``k`` rows reach the
    driver."""
    name = F.sha2(F.concat(F.lit(params.seed), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    least = rows.select(name.alias("h"), "v").orderBy("h", "v").limit(params.k).collect()
    return np.array([r.v for r in least], np.int64).reshape(len(least), params.dimension)


def choose_pivots(centroids: np.ndarray, n: int) -> np.ndarray:
    """``n`` of the vectors, each the farthest from those before it."""
    if not len(centroids):
        return centroids
    chosen = [0]
    away = ((centroids - centroids[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(centroids)):
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((centroids - centroids[chosen[-1]]) ** 2).sum(1))
    return centroids[chosen]


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    lists = column(batch, name)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel(), kind))


def _parts(batch: pa.RecordBatch):
    for start in range(0, batch.num_rows, ROWS_AT_ONCE):
        yield batch.slice(start, ROWS_AT_ONCE)


def pivot_table(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``rows`` with ``d``, the distance of the vector to each pivot; written
    once and read by every round."""
    kind = rows.schema["id"].dataType.simpleString()

    def work(batches):
        for whole in batches:
            for batch in _parts(whole):
                v = _matrix(batch, "v").astype(np.int64)
                d = np.stack([np.sqrt(((v - p) ** 2).sum(1).astype(np.float64)) for p in pivots], 1)
                yield pa.RecordBatch.from_arrays([column(batch, "id"), column(batch, "v"), _lists(d, pa.float64())], names=["id", "v", "d"])

    return materialise(rows.mapInArrow(work, f"id {kind}, v array<int>, d array<double>"), "pivot_table")


class Nearest:
    """Finds the nearest centroid of vectors by their pivot distances."""

    def __init__(self, centroids: np.ndarray, pivots: np.ndarray):
        self.centroids = centroids
        self.to_pivots = np.sqrt(((centroids[:, None, :] - pivots[None, :, :]) ** 2).sum(2).astype(np.float64))
        self.compared = 0

    def __call__(self, v: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroid, squared distance) of each vector; equal distances go to
        the smaller number."""
        n, k = len(v), len(self.centroids)
        bound = np.zeros((n, k))
        for p in range(d.shape[1]):
            np.maximum(bound, np.abs(d[:, p, None] - self.to_pivots[None, :, p]), out=bound)
        # The bound holds for exact roots; the margin covers their rounding.
        bound -= SLACK * (d.max(1, keepdims=True) + self.to_pivots.max() + 1)
        guess = bound.argmin(1)
        first = self._squared(v, guess)
        row, c = np.nonzero(bound <= np.sqrt(first.astype(np.float64))[:, None] * (1 + SLACK))
        exact = np.empty(len(row), np.int64)
        for a in range(0, len(row), 8 * ROWS_AT_ONCE):
            b = a + 8 * ROWS_AT_ONCE
            exact[a:b] = self._squared(v[row[a:b]], c[a:b])
        self.compared += n + len(row)
        # Rows are in order, so are the centroids of each: the first least wins.
        starts = np.searchsorted(row, np.arange(n))
        least = np.minimum.reduceat(exact, starts)
        hit = np.flatnonzero(exact == least[row])
        best = hit[np.searchsorted(row[hit], np.arange(n))]
        return c[best], least

    def _squared(self, v: np.ndarray, c: np.ndarray) -> np.ndarray:
        return ((v - self.centroids[c]) ** 2).sum(1)


def _moved(sums: list, centroids: np.ndarray) -> np.ndarray:
    """Centroids moved to the exact means, rounded down; empty ones stay."""
    new = centroids.copy()
    for r in sums:
        new[r.cluster, r.place] = int(r.total) // r.n
    return new


def _sums(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> list:
    """(cluster, place, n, total): the sum of each component over the vectors
    nearest to each centroid.  A task sums its rows before anything is
    shuffled; sums of sums are decimals."""
    k, dimension = centroids.shape

    def work(batches):
        nearest = Nearest(centroids, pivots)
        n, total = np.zeros(k, np.int64), np.zeros(centroids.shape, np.int64)
        for whole in batches:
            for batch in _parts(whole):
                v = _matrix(batch, "v").astype(np.int64)
                number, _ = nearest(v, _matrix(batch, "d"))
                n += np.bincount(number, minlength=k)
                np.add.at(total, number, v)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, dimension), pa.int32()), pa.array(np.tile(np.arange(dimension), len(used)), pa.int32()),
             pa.array(np.repeat(n[used], dimension)), pa.array(total[used].ravel())], names=["cluster", "place", "n", "total"])

    parts = table.select("v", "d").mapInArrow(work, "cluster int, place int, n long, total long")
    return parts.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()


def assign(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """(id, cluster, distance): the nearest centroid and the squared distance."""
    kind = table.schema["id"].dataType.simpleString()

    def work(batches):
        nearest = Nearest(centroids, pivots)
        for whole in batches:
            for batch in _parts(whole):
                cluster, squared = nearest(_matrix(batch, "v").astype(np.int64), _matrix(batch, "d"))
                yield pa.RecordBatch.from_arrays([column(batch, "id"), pa.array(cluster, pa.int32()), pa.array(squared, pa.int64())],
                                                 names=["id", "cluster", "distance"])

    return table.mapInArrow(work, f"id {kind}, cluster int, distance long")


def cluster(vectors: DataFrame, params: ClusterParams = ClusterParams(), id_col: str = "vec_id",
            vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """(rows, centroids): per vector ``id, cluster, distance`` (squared),
    already written, and the final centroids.

    Vectors of another length, and those with a null, infinite or NaN
    component, are left out.  With fewer vectors than ``k`` there are as many
    centroids as vectors; without any the result is empty.  Null ids are
    hashed as the seed alone and come back null; repeated rows and ids count
    as often as given; other columns are ignored.  Scaled components of
    ``LARGEST`` or more cannot be compared exactly in 64 bits and raise.
    """
    ship_package(vectors.sparkSession)
    rows = integer_vectors(vectors, params, id_col, vector_col)
    centroids = first_centroids(rows, params)
    pivots = choose_pivots(centroids, params.pivots)
    kind = rows.schema["id"].dataType.simpleString()
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], f"id {kind}, cluster int, distance long"), centroids
    table = pivot_table(rows, pivots)
    for _ in range(params.rounds):
        centroids = _moved(_sums(table, centroids, pivots), centroids)  # k x dimension numbers
    return materialise(assign(table, centroids, pivots), "assigned"), centroids


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def with_inertia(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``rows`` with ``cluster_inertia``, ``inertia`` and ``centroid_sha256``."""
    sums = rows.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()  # k rows
    listed = [(r.cluster, r.inertia, sum(x.inertia for x in sums), centroid_digest(centroids[r.cluster])) for r in sums]
    about = rows.sparkSession.createDataFrame(listed, "number int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(about), F.col("cluster") == F.col("number")).drop("number")
