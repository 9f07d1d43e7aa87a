import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from provenir.llm import mixing

SCHEMA = "doc_id long, text string, source string, n_chars long, size string, begin int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, len(t or ""), "x", 1) for i, t, s in rows], SCHEMA)


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        above = [s for s in rest if share[s] > most * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: most * sizes[s] for s in above}


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 5, "c": 900, None: 40}, {"x": 10}, {"a": 1, "b": 1, "c": 1, "d": 997}, {"a": 0, "b": 30, None: 2}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long").select(mixing._source_key(F.col("source")).alias("source_key"), "source_size", "source")
    got = {r["source_key"]: r["target"] for r in mixing.targets(rows).collect()}
    wanted = {("1" if s is None else "0" + s): t for s, t in brute_targets(sizes).items()}
    assert got == pytest.approx(wanted)


def test_permutation(spark):
    for n in (1, 2, 7, 1000):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3), F.lit("k")).alias("p")).collect()
        assert sorted(r["p"] for r in got) == list(range(n))
    assert [r["p"] for r in got] != list(range(1000))


def test_mix(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    told, pieces = mixing.mix(docs)
    rows = told.collect()
    texts = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in docs.collect()}
    assert {r["doc_id"]: r["size"] for r in rows} == texts and len(rows) == len(texts)
    size, taken, target = Counter(), Counter(), {}
    for r in rows:
        assert r["taken"] <= 3 * r["size"]
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert target == pytest.approx(brute_targets(dict(size)))
    assert {r["source"]: r["source_size"] for r in rows} == dict(size)
    for s, t in target.items():
        assert abs(taken[s] - t) <= 0.03 * t + 64, (s, taken[s], t)
    again = mixing.mix(docs.repartition(7))[0].collect()
    assert {r["doc_id"]: r["taken"] for r in again} == {r["doc_id"]: r["taken"] for r in rows}
    by_piece = {r["doc_id"]: r["n"] for r in pieces.groupBy("doc_id").agg(F.sum("n_words").alias("n")).collect()}
    assert by_piece == {r["doc_id"]: r["taken"] for r in rows if r["taken"]}


def hashed(*values):
    """Spark's xxhash64 of integers (4 bytes) and longs (8 bytes)."""
    h = 42
    for v, width in values:
        h = xxhash.xxh64_intdigest(v.to_bytes(width, "little", signed=True), h)
    return h - (1 << 64) if h >= 1 << 63 else h


def plain_counts(slots, shard_slots, seed):
    """The draw of every slot, one after the other."""
    left, found, turn = dict(slots), Counter(), 0
    total = sum(slots.values())
    rooms = {s: min(shard_slots, total - s * shard_slots) for s in range(-(-total // shard_slots))}
    while sum(left.values()):
        ends, at = [], 0
        for k in sorted(left):
            ends.append((at, at + left[k], k))
            at += left[k]
        over = Counter()
        for s in sorted(rooms):
            for i in range(1, rooms[s] + 1):
                ticket = hashed((seed, 4), (turn, 4), (s, 8), (i, 8)) % at
                over[s, next(k for lo, hi, k in ends if lo <= ticket < hi)] += 1
        for (s, k), n in sorted(over.items()):
            kept = min(n, left[k])
            left[k] -= kept
            found[s, k] += kept
            rooms[s] -= kept
        turn += 1
    return +found


def test_counts_are_multinomial_draws(spark):
    slots = {"0a": 700, "0b": 300, "0c": 7, "0d": 0, "1": 90}
    wanted = spark.createDataFrame([(k, n, 0, i) for i, (k, n) in enumerate(sorted(slots.items()))], "source_key string, slots long, part int, pos int")
    rows = mixing.slot_counts(wanted, 64, 5).collect()
    got = Counter()
    for r in rows:
        got[r["shard"], r["source_key"]] += r["count"]
    assert got == plain_counts(slots, 64, 5)
    numbers = {}
    for r in rows:
        numbers.setdefault(r["source_key"], []).extend(range(r["first"], r["first"] + r["count"]))
    assert {k: sorted(v) for k, v in numbers.items()} == {k: list(range(n)) for k, n in slots.items() if n}
    shards = [got[s, "0a"] for s in range(16)]
    assert len(set(shards)) > 5 and 28 < sum(shards) / 16 < 54


def test_repeated_rows_are_given_what_is_told(spark):
    text = " ".join(f"r{k}" for k in range(132))
    rows = [(1, text, "a"), (1, text, "a"), (1, text, "a"), (1, text, "b"), (2, text, "a"), (2, "other words " * 30, "a"), (None, text, "b"), (None, text, "b"), (3, None, "b")]
    docs = frame(spark, rows)
    told = mixing.mix(docs, block=8)[0].collect()
    assert len(told) == len(rows) and all(r["taken"] <= 3 * r["size"] for r in told)
    taken, words = Counter(), Counter()
    for r in told:
        taken[r["doc_id"], r["source"]] += r["taken"]
    for r in mixing.mixed_documents(docs, block=8).collect():
        words[r["doc_id"], r["source"]] += len(WORD.findall(r["text"]))
    assert +words == +taken
    for s in "ab":
        assert abs(sum(r["taken"] for r in told if r["source"] == s) - next(r["target"] for r in told if r["source"] == s)) <= 16


def test_many_sources(spark):
    rows = spark.range(900).select(F.format_string("0s%05d", "id").alias("source_key"), (F.col("id") % 7).alias("source_size"))
    sizes = {f"s{i:05d}": i % 7 for i in range(900)}
    placed = mixing.running(mixing.ranked(rows, "source_key", 100), F.lit(1), "nth").collect()
    assert len({r["part"] for r in placed}) > 4 and [r["source_key"] for r in sorted(placed, key=lambda r: r["nth"])] == ["0" + s for s in sorted(sizes)]
    got = {r["source_key"][1:]: r["target"] for r in mixing.targets(rows).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_documents_hold_what_is_taken(spark):
    docs = frame(spark, [(k, f"  word{k} " + " ".join(f"x{k}_{j}" for j in range(k * 7)) + "\n", f"s{k % 3}") for k in range(20)])
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(docs, block=4)[0].collect()}
    made = mixing.mixed_documents(docs, block=4)
    assert made.columns == docs.columns
    words = Counter()
    for r in made.collect():
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
        assert r["n_chars"] == len(r["text"])
    assert dict(words) == {k: v for k, v in taken.items() if v}


def test_edges(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, " ", None), (4, "one two", None), (4, "one two", None), (None, "three", "b"), (5, "w " * 50_000, "b"), (6, "tie tie", "")]
    got = mixing.mix(frame(spark, rows))[0].collect()
    assert len(got) == 8 and sum(r["size"] for r in got) == 2 + 2 + 1 + 50_000 + 2
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    assert mixing.mix(frame(spark, []))[0].count() == 0 and mixing.mixed_documents(frame(spark, [])).count() == 0
    assert mixing.mix(frame(spark, [(1, None, None)]))[0].first()["taken"] == 0
