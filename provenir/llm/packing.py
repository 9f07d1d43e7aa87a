"""Packing token sequences: shortest-pack-first over the length histogram."""

from __future__ import annotations

import heapq
import json
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import salted_rank, salts_for, staged, tidy

CACHED, LONGEST_CACHED = 150_000, 48


class TokenIds:
    """Ids of a byte-level BPE vocabulary, equal to tokenizers' `encode(text, add_special_tokens=False)`.

    Vocabulary, added tokens and merges order come from the tokenizer's JSON file. Texts are cut before
    spaces that no other white space surrounds, where the pre-tokenizer cuts too, and the ids of a cut
    are kept in a bounded cache; a text in which a space stands inside a run of white space is encoded whole.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        of_char = _bytes_of_chars()
        ranks = {bytes(of_char[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in added}
        pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        self._bpe = tiktoken.Encoding("json", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)
        self._added = list(added)
        self._inside = regex.compile(r"\s (?:\s|\Z)")
        self._cache: dict[str, bytes] = {}

    def _raw(self, text: str) -> bytes:
        return array("I", self._bpe.encode(text, allowed_special="all")).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if any(t in text for t in self._added) or self._inside.search(text):
            return self._raw(text)
        first, *rest = text.split(" ")
        cache = self._cache
        out = [self._raw(first)]
        for chunk in rest:
            ids = cache.get(chunk)
            if ids is None:
                ids = self._raw(" " + chunk)
                if len(chunk) <= LONGEST_CACHED:
                    if len(cache) >= CACHED:
                        cache.clear()
                    cache[chunk] = ids
            out.append(ids)
        return b"".join(out)


def _bytes_of_chars() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def _pieces(tokenizer: str, capacity: int, end_id: int, payload: str | None):
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64())]
    fields += [("ids", pa.binary())] if payload == "ids" else [("ids_crc32", pa.int64())] if payload == "crc32" else []
    schema = pa.schema(fields)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = TokenIds(tokenizer), array("I", [end_id]).tobytes()
        for batch in batches:
            rows: list[list] = [[] for _ in fields]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = encoder.encode(text.as_py() or "") + end
                total = len(data) // 4
                for start in range(0, total, capacity):
                    ids = data[4 * start : 4 * (start + capacity)]
                    made = (doc_id, start, len(ids) // 4, total, ids if payload == "ids" else zlib.crc32(ids))
                    for column, value in zip(rows, made):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, (_, t) in zip(rows, fields)], schema=schema)

    kinds = {"ids": ", ids binary", "crc32": ", ids_crc32 long", None: ""}
    return run, "doc_id long, start long, length long, doc_tokens long" + kinds[payload]


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """Patterns of packs for a histogram {length: count}, as intervals (length, first rank, first sequence, offset).

    Lengths are placed longest first, each into the packs with most room. Packs of equal content are kept
    as one pattern with a count; a pattern splits when fewer pieces than packs are left. Piece `first rank + i`
    of a length goes to sequence `first sequence + i`. The work depends on the lengths, not on the pieces.
    """
    open_packs: list[tuple[int, int, int, int]] = []  # (-room, first sequence, packs)
    out: list[tuple[int, int, int, int]] = []
    sequences = 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            if not open_packs or -open_packs[0][0] < length:
                packs = -(-left // (capacity // length))
                heapq.heappush(open_packs, (-capacity, sequences, packs))
                sequences += packs
            room, first, packs = heapq.heappop(open_packs)
            used = min(left, packs)
            out.append((length, rank, first, capacity + room))
            if -room > length:
                heapq.heappush(open_packs, (room + length, first, used))
            if packs > used:
                heapq.heappush(open_packs, (room, first + used, packs - used))
            left, rank = left - used, rank + used
    return out


def _placed(intervals: list[tuple[int, int, int, int]], carried: str):
    """Adds sequence and offset to ranked pieces; the intervals are few whatever the number of pieces."""
    table = np.array(sorted(intervals), dtype=np.int64).reshape(-1, 4)
    keys = (table[:, 0] << 48) + table[:, 1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, (length << 48) + rank, side="right") - 1
            kept = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(table[at, 2] + rank - table[at, 1]), pa.array(table[at, 3])],
                names=[*kept, "sequence_id", "offset"],
            )

    return run, f"{carried}, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, payload: str | None = "ids") -> DataFrame:
    """Packs every document of `docs` (doc_id, text) into sequences of at most `capacity` tokens.

    A document is its token ids and `end_id`; it is cut into pieces of `capacity` and a rest. Returned per piece:
    doc_id, start, length, doc_tokens, the payload (`ids`, little-endian unsigned 32-bit; or `ids_crc32`; or none),
    sequence_id and offset. Null and empty texts are the end id alone; a very long text is cut into as many pieces as it
    needs, and a task holds one text's ids at a time; pieces of one length go in order of a hash of doc_id, start and
    payload, so ties do not meet in one task; repeated rows are packed each; columns other than doc_id and text are
    ignored, whatever their names; an empty table gives no rows. The histogram of lengths has at most `capacity` rows and
    is what reaches the driver.
    """
    cut, kind = _pieces(tokenizer, capacity, end_id, payload)
    pieces = staged(docs.select("doc_id", "text").mapInArrow(tidy(cut), kind), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    intervals = shortest_pack_first(histogram, capacity)
    told = {"ids": ["ids"], "crc32": ["ids_crc32"], None: []}[payload]
    ranked = salted_rank(pieces, ["length"], ["doc_id", "start", *told], salts_for(sum(histogram.values())), "rank")
    place, schema = _placed(intervals, kind)
    return ranked.select(*pieces.columns, F.col("rank")).mapInArrow(tidy(place), schema)
