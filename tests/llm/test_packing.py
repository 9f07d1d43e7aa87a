import random
import zlib

import numpy as np
import pytest

from provenir.llm import packing
from provenir.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, rank int, sequence_id string"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in texts], SCHEMA)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_ids_equal_tokenizers(tokenizer):
    ids = packing.TokenIds(tokenizer_path())
    pick = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "a", "bc", ".", "é", "1", "²", "Ⅷ", "\x1c", " ", "'s", "_", "<|endoftext|>", "日", "word ", "Über"]
    for _ in range(3000):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(0, 14)))
        assert np.frombuffer(ids.encode(text), dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_ids_of_all_of_unicode(tokenizer):
    ids = packing.TokenIds(tokenizer_path())
    pick = random.Random(5)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    blanks = [chr(c) for c in points if chr(c).isspace()]
    for k in range(0, len(points), 400):
        text = "".join(chr(c) + pick.choice(("", "", " ", "a", pick.choice(blanks))) for c in points[k : k + 400])
        assert np.frombuffer(ids.encode(text), dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, k


def test_texts_without_an_id_of_their_own(spark):
    rows = [(None, f"text {k} " * 9) for k in range(60)] + [(7, "same")] * 20
    got = packing.pack(docs(spark, rows), tokenizer_path(), 64, 1, payload="crc32").collect()
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == len(got) == 80


def test_every_id_once_and_gapless(spark, tokenizer):
    texts = [(1, None), (2, ""), (3, "one two three"), (3, "one two three"), (4, "word " * 5000), (None, "x"), *((k, "tie tie") for k in range(10, 40))]
    got = packing.pack(docs(spark, texts), tokenizer_path(), 64, 1, payload="ids").collect()
    spans = {}
    for r in got:
        assert len(r["ids"]) == 4 * r["length"] <= 4 * 64
        spans.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], bytes(r["ids"])))
    for doc_id, text in {(i, t) for i, t in texts}:
        wanted = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4").tobytes()
        pieces = sorted(set(spans[doc_id, len(wanted) // 4]))
        assert b"".join(p for _, p in pieces) == wanted and [s for s, _ in pieces] == list(range(0, len(wanted) // 4, 64))
    places = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    assert len([r for r in got if r["doc_id"] == 3]) == 2


def test_digest_is_of_the_ids(spark):
    texts = [(1, "some words here"), (2, "more " * 100)]
    ids = {(r["doc_id"], r["start"]): zlib.crc32(bytes(r["ids"])) for r in packing.pack(docs(spark, texts), tokenizer_path(), 32, 1).collect()}
    crc = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in packing.pack(docs(spark, texts), tokenizer_path(), 32, 1, payload="crc32").collect()}
    assert ids == crc


def test_empty(spark):
    assert packing.pack(docs(spark, []), tokenizer_path()).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_shortest_pack_first(seed):
    pick = random.Random(seed)
    histogram = {pick.randint(1, 100): pick.randint(1, 400) for _ in range(40)}
    placed = {}
    for length, rank, sequence, offset in packing.shortest_pack_first(histogram, 100):
        placed.setdefault(length, []).append((rank, sequence, offset))
    packs = {}
    for length, count in histogram.items():
        edges = sorted(placed[length])
        assert edges[0][0] == 0
        for (rank, sequence, offset), after in zip(edges, [e[0] for e in edges[1:]] + [count]):
            for i in range(after - rank):
                packs.setdefault(sequence + i, []).append((offset, length))
    assert sum(len(p) for p in packs.values()) == sum(histogram.values())
    for own in packs.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 100
    filled = sum(length for p in packs.values() for _, length in p)
    assert len(packs) <= -(-filled // 100) * 1.3 + 1
