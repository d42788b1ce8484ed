"""Lloyd's clustering in whole numbers, each vector compared only with the centroids whose norm its annulus holds.

Centroids are sorted by norm. The one whose norm is nearest to a vector's gives an upper bound u of its distance;
as | |c| - |x| | is at most the distance, only centroids with norms in [|x| - u, |x| + u] can be as near. Binary search
finds them, and exact integer distances decide among them. Norms and u are rounded, so the annulus is widened by more
than their rounding: a centroid on its boundary, which may tie, is always compared.

A round is one scan of the vectors. Only sums travel: one row per cluster and component of each task, then of all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.support import materialize

CLUSTERS, ROUNDS, COMPONENTS, SCALE = 8, 10, 64, 1024
#: Components in whole numbers are cut to this size, so that a squared distance of 64 fits a long.
LARGEST = 1 << 27
#: The annulus is wider by this share of its numbers; double precision rounds by less than 1e-15 of them.
SLACK = 1e-9
#: Rows compared at a time.
ROWS = 4096


class Annulus:
    """Centroids sorted by norm; ``nearest`` compares each vector with those in its annulus."""

    def __init__(self, centroids: list[list[int]]):
        rows = np.array(centroids or np.zeros((0, COMPONENTS)), np.int64)
        norms = _norms(rows)
        self.number = np.argsort(norms, kind="stable")
        self.centroids, self.norms = rows[self.number], norms[self.number]
        self.compared = 0

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of the nearest centroid of each row; of equally near ones the smallest number."""
        norms, last = _norms(vectors), len(self.norms) - 1
        above = np.minimum(np.searchsorted(self.norms, norms), last)
        below = np.maximum(above - 1, 0)
        first = np.where(np.abs(self.norms[below] - norms) < np.abs(self.norms[above] - norms), below, above)
        best, number = _squared(vectors, self.centroids[first]), self.number[first]
        bound = np.sqrt(best.astype(np.float64))
        slack = SLACK * (norms + bound + 1)
        start, stop = np.searchsorted(self.norms, norms - bound - slack, "left"), np.searchsorted(self.norms, norms + bound + slack, "right")
        self.compared += len(vectors)
        for k in range(last + 1):
            rows = np.flatnonzero((start <= k) & (k < stop) & (first != k))
            distance = _squared(vectors[rows], self.centroids[k])
            nearer = (distance < best[rows]) | ((distance == best[rows]) & (self.number[k] < number[rows]))
            best[rows[nearer]], number[rows[nearer]] = distance[nearer], self.number[k]
            self.compared += len(rows)
        return number, best


def _norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows * rows).sum(axis=1).astype(np.float64))


def _squared(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    apart = rows - others
    return (apart * apart).sum(axis=1)


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x): the vectors of 64 finite components, each in whole numbers of 1/1024 rounded down."""
    vector = F.col("embedding").cast("array<double>")
    odd = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    whole = F.transform("v", lambda v: F.floor(F.greatest(F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), v * SCALE))).cast("int"))
    rows = embeddings.select(F.col("vec_id").cast("long"), vector.alias("v")).where(F.size("v") == COMPONENTS).where(~F.exists("v", odd))
    return rows.select("vec_id", whole.alias("x"))


def _matrix(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of a batch with their vectors as rows of a matrix."""
    for i in range(0, batch.num_rows, ROWS):
        part = batch.slice(i, ROWS)
        yield part, part.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(part.num_rows, COMPONENTS)


def assigned(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(vec_id, cluster, distance) of every row of ``vectors(vec_id, x)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Annulus(centroids)
        for batch in batches:
            for part, rows in _matrix(batch, 1):
                number, distance = index.nearest(rows)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(number.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(run, "vec_id long, cluster int, distance long")


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: exact floors of the means; a centroid without vectors stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, sums = Annulus(centroids), np.zeros((len(centroids), COMPONENTS + 1), np.int64)
        for batch in batches:
            for _, rows in _matrix(batch, 0):
                number, _ = index.nearest(rows)
                for k in np.unique(number):
                    mine = rows[number == k]
                    sums[k] += np.r_[mine.sum(axis=0), len(mine)]
        k, c = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(c.astype(np.int32)), pa.array(sums[k, c])], names=["cluster", "component", "total"])

    totals = vectors.select("x").mapInArrow(run, "cluster int, component int, total long")
    # at most one row per cluster and component reaches the driver
    found = {(r.cluster, r.component): int(r.total) for r in totals.groupBy("cluster", "component").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()}
    means = lambda k, n: [found.get((k, c), 0) // n for c in range(COMPONENTS)]
    return [means(k, n) if (n := found.get((k, COMPONENTS), 0)) else old for k, old in enumerate(centroids)]


def cluster_vectors(embeddings: DataFrame, *, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) for every vector that is kept.

    Vectors of another length than 64, null ones and those that hold a null, NaN or infinite component aren't kept. The
    first centroids are the vectors with the smallest SHA-256 of ``3:<vec_id>`` (a null id counts as empty; of equal ids
    the smaller vector first), fewer of them if fewer vectors are kept. Rows that repeat an id are vectors of their own.
    Ties go to the smaller number. Whole components are cut at 2 ** 27 in size, where a long couldn't hold the distance; an
    inertia that a long can't hold is null. Other columns are ignored. An empty table gives no rows.
    """
    vectors = materialize(whole_vectors(embeddings))
    key = F.sha2(F.concat(F.lit("3:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    centroids = [list(r.x) for r in vectors.orderBy(key, "x").limit(clusters).collect()]
    if centroids:
        for _ in range(rounds):
            centroids = moved(vectors, centroids)
    last = materialize(assigned(vectors, centroids))
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    # as many rows as clusters
    whole = {r.cluster: int(r["sum"]) for r in last.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum")).collect()}
    fits = lambda n: n if n < 1 << 63 else None
    of = lambda values, kind: F.get(F.array(*(F.lit(v).cast(kind) for v in values)), F.col("cluster")) if values else F.lit(None).cast(kind)
    inertia = F.lit(fits(sum(whole.values()))).cast("long")
    return last.select("vec_id", "cluster", "distance", of([fits(whole.get(k, 0)) for k in range(len(centroids))], "long").alias("cluster_inertia"), inertia.alias("inertia"), of(names, "string").alias("centroid_sha256"))
