"""The annulus search against all distances, and whole clusterings against a loop."""

import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cairn.llm import annulus
from cairn.llm.annulus import Annulus, cluster_vectors


def nearest(centroids, rows):
    apart = ((rows[:, None, :] - np.array(centroids)[None]) ** 2).sum(axis=2)
    return apart.argmin(axis=1), apart.min(axis=1)


@given(st.lists(st.lists(st.integers(-4, 4), min_size=3, max_size=3), min_size=1, max_size=9), st.integers(0, 2**32 - 1))
@settings(max_examples=100, deadline=None)
def test_equals_all_distances_with_many_ties(centroids, seed):
    rows = np.random.default_rng(seed).integers(-5, 6, (60, 3))
    got, wanted = Annulus(centroids).nearest(rows), nearest(centroids, rows)
    assert (got[0] == wanted[0]).all() and (got[1] == wanted[1]).all()


def test_ties_on_the_annulus_and_equal_centroids():
    index = Annulus([[0, 4], [4, 0], [0, -4], [4, 0], [8, 0]])
    number, distance = index.nearest(np.array([[2, 2], [4, 0], [6, 0], [0, 0], [0, 1 << 27]]))
    assert number.tolist() == [0, 1, 1, 0, 0] and distance[:4].tolist() == [8, 0, 4, 16]


def test_far_centroids_are_not_compared():
    rng = np.random.default_rng(3)
    centroids = [(rng.normal(size=64) * 10 * 4**k).astype(int).tolist() for k in range(8)]
    rows = np.concatenate([np.array(c) + rng.integers(-2, 3, (200, 64)) for c in centroids])
    index = Annulus(centroids)
    got, wanted = index.nearest(rows), nearest(centroids, rows)
    assert (got[0] == wanted[0]).all() and (got[1] == wanted[1]).all() and index.compared < 2 * len(rows)


def by_loop(rows, clusters=8, rounds=10):
    kept = [(d, [int(np.floor(1024 * np.float64(x))) for x in v]) for d, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    kept = [(d, [max(-annulus.LARGEST, min(annulus.LARGEST, c)) for c in v]) for d, v in kept]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in first[:clusters]]
    if not kept:
        return []
    table = np.array([v for _, v in kept], object)

    def assign():
        found = [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroids)) for v in table.tolist()]
        return [k for _, k in found], [d for d, _ in found]

    for _ in range(rounds):
        of, _ = assign()
        for k in range(len(centroids)):
            mine = [v for v, c in zip(table.tolist(), of, strict=True) if c == k]
            if mine:
                centroids[k] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    of, distance = assign()
    fits = lambda n: n if n < 1 << 63 else None
    sums = [fits(sum(d for d, c in zip(distance, of, strict=True) if c == k)) for k in range(len(centroids))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((d, k, n, sums[k], fits(sum(distance)), names[k]) for (d, _), k, n in zip(kept, of, distance, strict=True)), key=str)


KIND = "vec_id long, embedding array<float>, label int, cluster int, distance string"


def frame(spark, rows):
    return spark.createDataFrame([(d, v, 1, 2, "x") for d, v in rows], KIND).repartition(3)


def test_odd_vectors(spark):
    rng = np.random.default_rng(8)
    vectors = [(k, [float(np.float32(x)) for x in rng.normal(size=64)]) for k in range(60)]
    odd = [(100, None), (101, []), (102, [1.0] * 63), (103, [1.0] * 65), (104, [*[1.0] * 63, None]), (105, [*[1.0] * 63, float("nan")]), (106, [*[1.0] * 63, float("-inf")]), (107, [0.0] * 64), (None, [-0.5] * 64), (3, vectors[3][1]), (3, [0.25] * 64)]
    got = cluster_vectors(frame(spark, vectors + odd))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == by_loop(vectors + odd)


def test_few_equal_and_huge_vectors(spark):
    for rows in ([(k, [0.5] * 64) for k in range(20)], [(1, [0.1] * 64), (2, [-0.1] * 64)], [(k, [float(np.float32(10.0 ** (k % 38)))] * 64) for k in range(40)]):
        assert sorted(map(tuple, cluster_vectors(frame(spark, rows)).collect()), key=str) == by_loop(rows)


def test_no_vectors(spark):
    assert cluster_vectors(frame(spark, [(1, None)])).count() == 0 and cluster_vectors(frame(spark, [(1, None)]).limit(0)).count() == 0


def test_other_numbers_of_clusters_and_rounds(spark):
    rng = np.random.default_rng(2)
    rows = [(k, [float(np.float32(x)) for x in rng.integers(-2, 3, 64)]) for k in range(50)]
    assert sorted(map(tuple, cluster_vectors(frame(spark, rows), clusters=3, rounds=2).collect()), key=str) == by_loop(rows, 3, 2)
