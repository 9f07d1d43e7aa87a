import hashlib
import math

import numpy as np
import pytest

from provenir.llm import clusters

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance string, hash int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y", 1) for i, v in rows], SCHEMA)


def brute(rows, k=40, rounds=5):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    centroids = [v for _, v in sorted((x for x in kept if x[0] is not None), key=lambda x: (hashlib.sha256(f"2:{x[0]}".encode()).hexdigest(), np.array(x[1], np.int32).tobytes()))[:k]]

    def assign(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(assign(v)[1], []).append(v)
        for j, vs in groups.items():
            centroids[j] = [sum(c) // len(vs) for c in zip(*vs)]
    told = [(i, *assign(v)[::-1]) for i, v in kept]
    inertia = {}
    for _, j, d in told:
        inertia[j] = inertia.get(j, 0) + d
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for i, j, d in told), key=repr)


def found(spark, rows, **options):
    return sorted((tuple(r) for r in clusters.cluster(frame(spark, rows), **options).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


def vectors(seed, n, kinds=9, noise=0.2):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(kinds, 64))
    return [(i, [float(x) for x in centres[i % kinds] + pick.normal(size=64) * noise]) for i in range(n)]


@pytest.mark.parametrize("seed, n, noise", [(0, 150, 0.2), (1, 120, 3.0), (2, 25, 0.0)])
def test_against_plain_rounds(spark, seed, n, noise):
    rows = vectors(seed, n, noise=noise)
    assert found(spark, rows) == brute(rows)


def test_edges(spark):
    assert found(spark, []) == [] and found(spark, [(1, None), (2, [1.0] * 63), (3, [float("nan")] * 64), (4, [None] * 64)]) == []
    assert found(spark, [(None, [1.0] * 64)]) == []
    rows = vectors(3, 20) + [(5, [0.0] * 64), (5, [0.0] * 64), (7, [-0.001] * 64), (None, [2.0] * 64), (90, None), (91, []), (92, [float("inf")] + [0.0] * 63), (93, [500_000.0, -500_000.0] * 32)]
    got = found(spark, rows)
    assert got == brute(rows)
    assert [r for r in found(spark, rows + [(99, [1e6] * 64), (98, [1e308] * 64)])] == got


def test_ties_go_to_the_smaller_cluster(spark):
    rows = [(k, [float(k % 2)] * 64) for k in range(30)] + [(100, [0.5] * 64)]
    assert found(spark, rows) == brute(rows)


def test_bounds_hold_and_prune():
    x = (np.concatenate([np.random.default_rng(k).normal(size=(100, 64)) * 30 + 400 * np.random.default_rng(k).normal(size=64) * (np.arange(64) // 8 % 4 == k % 4) for k in range(40)])).astype(np.int64)
    centroids = x[::100].copy()
    cluster, distance, computed = clusters.assigned(x, clusters.segment_norms(x), centroids)
    every = ((x[:, None, :] - centroids[None]) ** 2).sum(2)
    assert (cluster == every.argmin(1)).all() and (distance == every.min(1)).all()
    assert computed < 0.5 * every.size
