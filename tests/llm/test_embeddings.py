import numpy as np
import pytest

from provenir.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, unit string, tile int, copies string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, k, "x", 1, "y") for i, v, k in rows], SCHEMA)


def brute(rows, threshold=0.93):
    units = {}
    for i, v, k in rows:
        x = None if v is None or any(e is None for e in v) else np.array(v, dtype=np.float32).astype(np.float64)
        ok = x is not None and len(x) and np.isfinite(x).all() and x.any() and k is not None
        units[i] = (k, len(x), x / np.linalg.norm(x)) if ok else None
    ids, root, degree = sorted(units), {i: i for i in units}, {i: 0 for i in units}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if units[a] and units[b] and units[a][:2] == units[b][:2] and units[a][2] @ units[b][2] >= threshold:
                degree[a] += 1
                degree[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (degree[i], find(i), find(i) == i) for i in ids}


def found(spark, rows, **options):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_duplicates(frame(spark, rows), **options).collect()}


def vectors(seed, n=260, d=16):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(12, d))
    rows = []
    for i in range(n):
        v = centres[i % 12] + pick.normal(size=d) * pick.choice((0.0, 0.15, 0.4))
        rows.append((i, [float(x) for x in np.float32(v * pick.choice((1, 3, 1e-3)))], int(pick.integers(3))))
    return rows


@pytest.mark.parametrize("seed, tile", [(0, 16), (1, 1000)])
def test_against_all_pairs(spark, seed, tile):
    rows = vectors(seed) + [(900, None, 1), (901, [], 1), (902, [0.0] * 16, 1), (903, [1.0, None] * 8, 1), (904, [float("nan")] * 16, 1), (905, [float("inf")] + [1.0] * 15, 1), (906, [1.0] * 16, None), (907, [1.0] * 8, 1), (908, [2.0] * 8, 1)]
    assert found(spark, rows, tile_rows=tile) == brute(rows)


def test_copies_and_edges(spark):
    same = [1.0, 2.0, 3.0]
    got = found(spark, [(k, same, 0) for k in range(400)] + [(500, [3.0, -2.0, 1.0], 0)])
    assert got[0] == (399, 0, True) and got[399] == (399, 0, False) and got[500] == (0, 500, True)
    assert found(spark, []) == {}
    repeated = embeddings.near_duplicates(frame(spark, [(1, same, 0), (1, same, 0), (None, same, 0)])).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["kept"]) for r in repeated), key=repr) == sorted([(1, 1, True), (1, 1, True), (None, 0, True)], key=repr)


def test_pairs_are_the_plain_ones():
    pick = np.random.default_rng(3)
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (pick.normal(size=(50, 9)), pick.normal(size=(70, 9))))
    axes = np.linalg.qr(pick.normal(size=(9, 9)))[0]
    i, j = embeddings.close_pairs((a, b), (a @ axes, b @ axes), 0.6, step=2)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(a @ b.T >= 0.6))))


def test_more_than_a_thousand_tiles(spark):
    pick = np.random.default_rng(5)
    base = pick.normal(size=(1100, 6))
    rows = [(i, [float(x) for x in np.float32(base[i % 1100] + pick.normal(size=6) * 0.01)], 0) for i in range(2200)] + [(3000 + i, [1.0] * 6, 0) for i in range(30)]
    units = np.stack([np.array(v, dtype=np.float32).astype(float) for _, v, _ in rows])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    degree = (units @ units.T >= 0.999).sum(1) - 1
    placed = spark.createDataFrame([(i, "b", 1, float(u[0]), float(u[1])) for (i, _, _), u in zip(rows, units)], "class_id long, block string, copies long, lead double, second double")
    made = embeddings.tiled(placed, 0.999, 2).collect()
    sizes = {}
    for r in made:
        sizes[r["tile"]] = sizes.get(r["tile"], 0) + 1
    assert len(sizes) > 1000 and len(made) == len(rows)
    got = found(spark, rows, threshold=0.999, tile_rows=8)
    assert [got[i][0] for i, _, _ in rows] == degree.tolist()


def test_long_vectors_and_doubles(spark):
    pick = np.random.default_rng(8)
    base = pick.normal(size=(6, 3000))
    rows = [(i, [float(x) for x in base[i % 6] + pick.normal(size=3000) * 0.2], i % 2) for i in range(24)]
    made = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_duplicates(made).collect()}
    assert got == {i: (3, i % 6) for i in range(24)}
