import random

import numpy as np
import pandas as pd
import pytest

from provenir.llm import jaccard
from provenir.llm.common import components

SCHEMA = "doc_id long, text string, token string, block int"


def brute(rows, size=5, percent=80):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def found(spark, rows, **options):
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(frame, **options).collect()}


def corpus(seed):
    pick = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    passage = " ".join(pick.choice(vocabulary) for _ in range(30))
    rows = []
    for base in range(8):
        words = [pick.choice(vocabulary) for _ in range(pick.choice((6, 40, 120)))]
        for _ in range(pick.randint(1, 9)):
            copy = list(words)
            for _ in range(pick.choice((0, 0, 1, 1, 2, 3))):
                copy[pick.randrange(len(copy))] = pick.choice(vocabulary)
            rows.append(" ".join(copy) + ("\n" + passage if pick.random() < 0.3 else ""))
    rows += [None, "", " \t", "a", "A", "a b", "a b c d e", "a b c d e f", passage, passage.upper(), "long " * 3000]
    pick.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", range(2))
def test_against_all_pairs(spark, seed):
    rows = corpus(seed)
    assert found(spark, rows, tile_rows=4) == brute(rows)


def test_small_table_against_all_pairs(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert found(spark, rows) == brute(rows)


def test_empty_and_repeated_rows(spark):
    assert found(spark, []) == {}
    text = "one two three four five six"
    frame = spark.createDataFrame([(2, text), (2, text), (1, text), (None, text), (None, None)], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"]) for r in jaccard.jaccard_components(frame).collect()), key=repr)
    assert got == sorted([(2, 1), (2, 1), (1, 1), (None, 1), (None, None)], key=repr)


def test_threshold_is_exact():
    a = np.arange(10, dtype=np.uint64)
    sets = [a, a[:8], a[:7]]
    every = np.arange(3)
    assert sorted(jaccard.product_links(sets, every, every, 80)) == [(0, 1), (1, 2)]


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)}


def test_tiles_are_multiplied_in_parts(monkeypatch):
    pick = np.random.default_rng(9)
    base = [np.unique(pick.integers(0, 1 << 60, 40)).astype(np.uint64) for _ in range(12)]
    sets = [np.unique(np.concatenate([b[k:], pick.integers(0, 1 << 60, k).astype(np.uint64)])) for b in base for k in range(4)]
    seen, product = [], jaccard.product_links
    monkeypatch.setattr(jaccard, "product_links", lambda s, a, b, p: seen.append((len(a), len(b))) or product(s, a, b, p))

    def groups(links):
        root = list(range(len(sets)))
        for u, v in links:
            a, b = root[u], root[v]
            root = [min(a, b) if r in (a, b) else r for r in root]
        return root

    every, even, odd = np.arange(len(sets)), np.arange(0, len(sets), 2), np.arange(1, len(sets), 2)
    for left, right in ((every, every), (even, odd)):
        assert groups(jaccard.tile_links(sets, left, right, 80, part_rows=7)) == groups(product(sets, left, right, 80))
    assert max(map(max, seen)) == 7
    frame = pd.DataFrame({"key": range(40), "tile": 0, "data": [b"one two three four five six"] * 40})
    assert len(jaccard._cell(5, 80)((0, 0, 0), frame)) == 39


def test_product_is_that_of_plain_sets():
    pick = np.random.default_rng(3)
    common = np.arange(1000, 1060, dtype=np.uint64)
    sets = [np.unique(np.concatenate([common[pick.random(60) < 0.95], pick.integers(0, 40, pick.integers(1, 9)).astype(np.uint64)])) for _ in range(120)]
    left, right = np.arange(0, 70), np.arange(40, 120)
    wanted = [(i, j) for i in left for j in right if i != j and 100 * len(both := np.intersect1d(sets[i], sets[j])) >= 80 * (len(sets[i]) + len(sets[j]) - len(both))]
    assert 0 < len(wanted) < len(left) * len(right)

    def groups(links):
        root = list(range(len(sets)))
        for u, v in links:
            a, b = root[u], root[v]
            root = [min(a, b) if r in (a, b) else r for r in root]
        return root

    assert groups(jaccard.product_links(sets, left, right, 80)) == groups(wanted)


def test_joined_postings_connect_what_a_token_holds():
    keys, n = np.arange(50), np.array([10] * 40 + [12] * 5 + [1000] * 5)
    token = np.full(50, 7)
    out = [r for batch in jaccard._joined(80)(np.append(token, token[:3]), np.append(keys, keys[:3]), np.append(n, n[:3])) for r in batch.to_pylist()]
    assert len(out) == 50 and sum(r["place"] == 7 for r in out) == len({r["size"] & 1022 for r in out}) and all(r["size"] & 1 for r in out)
    assert all((r["other"] is None) == (r["place"] == 7) for r in out)


def test_block_of_many_short_sets_stays_in_small_tiles(spark):
    rows = [(i, 0, 3 + i % 7, i % 5) for i in range(3000)]
    made = jaccard.tiled(spark.createDataFrame(rows, "key long, block long, n_shingles long, extra int"), 80, 64, 10_000).collect()
    sizes, bins = {}, {}
    for r in made:
        sizes[r["tile"]] = sizes.get(r["tile"], 0) + 1
        bins.setdefault(r["n_shingles"], set()).add(r["tile"])
    assert len(made) == 3000 and max(sizes.values()) <= 128
    others = {r["tile"]: set(r["others"]) for r in made}
    for a in range(3, 10):
        for b in range(a, 10):
            if 100 * a >= 80 * b:
                assert all(t in others[u] and u in others[t] for t in bins[a] for u in bins[b])


def test_rows_that_share_an_id(spark):
    one, two = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    rows = [(1, one), (1, two), (1, two), (2, one + " end"), (3, two + " end"), (None, one + " more"), (None, " ".join(f"c{k}" for k in range(9)))]
    got = sorted(((r["doc_id"], r["component_id"]) for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == sorted([(1, 1), (1, 1), (1, 1), (2, 1), (3, 1), (None, 1), (None, None)], key=repr)
