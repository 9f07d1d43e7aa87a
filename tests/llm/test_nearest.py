import numpy as np
import pytest

from provenir.llm import nearest

SCHEMA = "vec_id long, embedding array<float>, rank int, score string, list int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)


def usable(v):
    x = None if not v or any(e is None for e in v) else np.array(v, dtype=np.float32).astype(np.float64)
    return x if x is not None and np.isfinite(x).all() and x.any() else None


def brute(rows, k=20):
    held = sorted({(i, x.tobytes()) for i, v in rows if i is not None and (x := usable(v)) is not None})
    held = [(i, np.frombuffer(x)) for i, x in held]
    return {
        (q, x.tobytes()): sorted((-float((x * y).sum()), i) for i, y in held if i != q and len(x) == len(y))[:k]
        for q, x in held if q % 20 == 0
    }


def found(spark, rows, **options):
    got = {}
    for r in nearest.nearest(frame(spark, rows), **options).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (-r["score"], r["vec_id"])
    return {q: [by[k] for k in sorted(by)] for q, by in got.items()}


def vectors(seed, n, d=16, kinds=30, noise=0.4):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(kinds, d))
    return [(i, [float(x) for x in np.float32((centres[i % kinds] + pick.normal(size=d) * noise) * pick.choice((1, 2, 0.3)))]) for i in range(n)]


def test_one_list_is_exact(spark):
    rows = vectors(0, 300) + [(400, [2.0] * 8), (401, [1.0] * 8), (402, None), (403, []), (404, [0.0] * 16), (405, [1.0, None] * 8), (406, [float("nan")] * 16), (407, [float("inf")] * 16), (None, [1.0] * 16)]
    want = {q: near for (q, _), near in brute(rows).items()}
    assert found(spark, rows) == want and len(want[400]) == 1


@pytest.mark.parametrize("seed, noise", [(1, 0.3), (2, 3.0)])
def test_recall_and_parts(spark, seed, noise):
    rows = vectors(seed, 3000, noise=noise)
    want = {q: near for (q, _), near in brute(rows).items()}
    got = found(spark, rows, list_rows=64, part_rows=50, chunk_rows=20)
    assert got.keys() == want.keys() and all(len(near) == 20 for near in got.values())
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * 20 * len(want)
    assert all(near == sorted(near) for near in got.values())


def test_sample_is_bounded_and_all_is_indexed(spark):
    rows = vectors(3, 3000)
    want = {q: near for (q, _), near in brute(rows).items()}
    got = found(spark, rows, list_rows=64, most_sampled=500)
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * 20 * len(want)


def test_a_tight_crowd_and_copies(spark):
    pick = np.random.default_rng(4)
    crowd = [(i, [float(x) for x in np.float32(np.ones(16) + pick.normal(size=16) * 0.01)]) for i in range(1000, 2000)]
    rows = vectors(5, 1000) + crowd + [(i, [3.0, 4.0] * 8) for i in range(3000, 3500)]
    want = {q: near for (q, _), near in brute(rows).items()}
    got = found(spark, rows, list_rows=64)
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * 20 * len(want)
    assert [i for _, i in got[3000]] == [*range(3001, 3021)] and [i for _, i in got[3020]] == [*range(3000, 3020)]


def test_ties_repeats_and_empty(spark):
    assert found(spark, []) == {}
    assert found(spark, [(20, [1.0, 2.0])]) == {}
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (7, [2.0, 1.0]), (3, [2.0, -1.0]), (5, [2.0, 5.0]), (5, [2.0, 5.0]), (9, [-1.0, 1.0])]
    assert found(spark, rows) == {0: [(-2.0, 3), (-2.0, 5), (-2.0, 7), (1.0, 9)]}
    assert found(spark, [(0, [1e-30, 0.0]), (1, [3e37, 1.0]), (2, [-1e-30, 1.0])])[0][0][1] == 1


def test_graph_reaches_every_near_centroid():
    x = np.random.default_rng(6).normal(size=(4096, 8))
    centroids = nearest.balanced_centroids(x, 256)
    sizes = np.bincount(((x[:, None, :] - centroids[None]) ** 2).sum(2).argmin(1), minlength=256)
    assert len(centroids) == 256 and sizes.max() <= 10 * sizes.mean()
    index = nearest.Index.of(centroids, 1.0)
    away = np.sqrt(((x[:500, None, :] - centroids[None]) ** 2).sum(2))
    got = index.distances(x[:500], 1.2)
    near = away <= 1.2 * away.min(1)[:, None]
    assert np.allclose(got[np.isfinite(got)], away[np.isfinite(got)]) and np.isfinite(got[near]).mean() > 0.99
