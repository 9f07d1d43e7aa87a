"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from .common import components, staged, tidy, unstage

BUCKETS = 1 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Shingles:
    """Distinct hashes (64 bits) of a text's n-word shingles, sorted; A-Z lower-cased, words cut at ASCII white space."""

    def __init__(self, size: int):
        self.size = size

    def of(self, text: bytes | None) -> np.ndarray:
        words = (text or b"").lower().split()
        if not words:
            return np.empty(0, dtype=np.uint64)
        h = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), dtype=">u8").astype(np.uint64)
        width = min(self.size, len(h))
        n = len(h) - width + 1
        acc = h[:n] + np.uint64(width)
        for k in range(1, width):
            acc *= _MULTIPLIER
            acc += h[k : k + n]
            acc ^= acc >> np.uint64(29)
        acc *= np.uint64(0xBF58476D1CE4E5B9)
        acc ^= acc >> np.uint64(32)
        acc.sort()
        return acc[np.concatenate(([True], acc[1:] != acc[:-1]))] if (acc[1:] == acc[:-1]).any() else acc


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes | None]]:
    return zip(batch.column(0).to_pylist(), (x.as_py() for x in batch.column(1)))


def _set_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _short(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def _summaries(size: int):
    """Per document: number of shingles and a hash of the set, long and short; per task: counts of shingles by hash bucket."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, counts = Shingles(size), np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            ids, sizes, keys = [], [], []
            for doc_id, text in _texts(batch):
                s = shingles.of(text)
                ids.append(doc_id)
                sizes.append(len(s))
                keys.append(_set_key(s) if len(s) else None)
                np.add.at(counts, (s & np.uint64(BUCKETS - 1)).astype(np.int64), 1)
            yield _batch(ids, sizes, keys, [None if k is None else _short(k) for k in keys], [None] * len(ids))
        if counts.any():
            parts = counts.reshape(64, -1)
            yield _batch([None] * 64, list(range(64)), [None] * 64, [None] * 64, [p.tobytes() for p in parts])

    return run, "doc_id long, n_shingles long, set_key binary, key long, counts binary"


def _batch(*columns: list) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "n_shingles", "set_key", "key", "counts"])


def _merged(kind: type, combine: Callable[[np.ndarray, np.ndarray], np.ndarray]):
    """Combines arrays (bytes) of equal part number."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(raw.as_py(), dtype=kind)
                total[part] = combine(total[part], own) if part in total else own
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["part", "data"])

    return run


def _gathered(parts: DataFrame, kind: type, combine: Callable[[np.ndarray, np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The whole array of `size` items that 64 numbered parts (part, data) make, combined over tasks on the executors."""
    out = np.zeros(size, dtype=kind)
    for r in parts.repartition("part").mapInArrow(_merged(kind, combine), "part long, data binary").collect():
        width = size // 64
        out[r["part"] * width : (r["part"] + 1) * width] = np.frombuffer(r["data"], dtype=kind)
    return out


#: Bits of the bitmap of wanted ids, each way from what small tables need to 64 MB.
LEAST_MARKS, MOST_MARKS = 1 << 20, 1 << 29


def _mark(ids: pa.Array, marks: int) -> np.ndarray:
    """Places of ids in a bitmap of `marks` bits."""
    shift = np.uint64(64 - marks.bit_length() + 1)
    return ((ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.uint64) * _MULTIPLIER) >> shift).astype(np.int64)


def _marked(marks: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(marks // 8, dtype=np.uint8)
        for batch in batches:
            at = _mark(batch.column(0), marks)
            np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        if bits.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(64), pa.int64()), pa.array([p.tobytes() for p in bits.reshape(64, -1)], pa.binary())], names=["part", "data"])

    return run


def _holding(bits: np.ndarray, marks: int, size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(size)
        for batch in batches:
            at = _mark(batch.column(0), marks)
            held = batch.filter(pa.array((bits[at >> 3] >> (at & 7)) & 1 == 1))
            sets = (shingles.of(text) for _, text in _texts(held))
            keys = [_short(_set_key(s)) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([held.column(0), pa.array(keys, pa.int64()), held.column(1)], names=["doc_id", "key", "data"])

    return run


def texts_of(rows: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """`rows` (doc_id, data) with the key of their set, without most of those that `wanted` (doc_id) lacks; to be joined with it.

    The wanted ids are marked in a bitmap of 16 bits an id, 64 MB at most; a row whose mark is not set is left where it
    is, so that texts which no join needs are not shuffled. A fuller bitmap lets more rows through and changes nothing else.
    """
    n = max(1, wanted.count())
    marks = min(MOST_MARKS, max(LEAST_MARKS, 1 << (16 * n - 1).bit_length()))
    bits = _gathered(wanted.select("doc_id").mapInArrow(_marked(marks), "part long, data binary"), np.uint8, np.bitwise_or, marks // 8)
    return rows.mapInArrow(tidy(_holding(bits, marks, size)), "doc_id long, key long, data binary")


def _needed(n: np.ndarray | int, percent: int):
    """Least overlap that a set of n can have with any partner: a partner holds at least percent % of it."""
    return -(-n * percent // 100)


def _common(n: np.ndarray | int, percent: int, share: int):
    """Tokens that a set of n must have in common with a partner inside their lengthened prefixes."""
    return n * share // 100 + 1


def _prefixes(size: int, percent: int, share: int, load: np.ndarray):
    """The rarest shingles of each set, and how many of them a linked set must hold as well.

    In any common order two linked sets share l of their first n - needed + l. l is a share of n that grows with it,
    and a partner holds at least percent % of n, so it is taken at that size. A task gives a set once, however many of
    its documents have it, and joins the sets of one token and size among its own before it hands them on (`_joined`).
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen, join = Shingles(size), set(), _joined(percent)
        tokens, keys, counts, sizes, held = [], [], [], [], 0
        for batch in batches:
            for _, text in _texts(batch):
                s = shingles.of(text)
                key = _short(_set_key(s)) if len(s) else None
                if key is None or key in seen:
                    continue
                seen.add(key)
                least = int(_needed(len(s), percent))
                k = len(s) - least + int(_common(len(s), percent, share))
                rare = s[np.lexsort((s, load[(s & np.uint64(BUCKETS - 1)).astype(np.int64)]))[:k]]
                tokens.append(rare.view(np.int64))
                keys.append(key)
                counts.append(len(rare))
                sizes.append(len(s))
                held += len(rare)
                if held >= CHUNK:
                    yield from join(*_flat(tokens, keys, counts, sizes))
                    tokens, keys, counts, sizes, held = [], [], [], [], 0
        if held:
            yield from join(*_flat(tokens, keys, counts, sizes))

    return run


def _flat(tokens: list[np.ndarray], keys: list[int], counts: list[int], sizes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    owner, n = (np.repeat(np.array(x, dtype=np.int64), np.array(counts, dtype=np.int64)) for x in (keys, sizes))
    return np.concatenate(tokens), owner, n


#: Postings that a task joins at once.
CHUNK = 1 << 18
#: `size`: the set's size, its bin (9 bits) and whether the row stands for others too (1 bit). A token equal to its place is left out.
POSTING = "place long, token long, key long, size long, other long"


def size_bin(n, percent: int):
    """A number that differs by one at most between sets whose sizes allow a link."""
    return np.floor(np.log(n) / (np.log(100 / percent) * (1 + 1e-6) + 1e-12)).astype(np.int64)


def _joined(percent: int):
    """Chunks of postings (token, key, n) as rows of POSTING, the sets of one token and bin joined with their first.

    The first stands for them: its row goes to its token's place and says whether it stands for others too. The others
    have a partner already; they go to a place of their own, so that a token held by very many sets is not gathered.
    """

    def run(token: np.ndarray, key: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        bins = size_bin(n, percent)
        order = np.lexsort((key, bins, token))
        token, key, n, bins = (x[order] for x in (token, key, n, bins))
        once = np.ones(len(token), dtype=bool)
        once[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
        token, key, n, bins = token[once], key[once], n[once], bins[once]
        first = np.ones(len(token), dtype=bool)
        first[1:] = (token[1:] != token[:-1]) | (bins[1:] != bins[:-1])
        at = np.nonzero(first)[0]
        many = np.diff(np.append(at, len(token))) > 1
        group = np.cumsum(first) - 1
        own = (token.astype(np.uint64) * _MULTIPLIER + key.astype(np.uint64)).view(np.int64)
        size, other = (n << 10) + (bins << 1) + many[group], key[at][group]
        # handed on in the order that they came in, set by set, which packs better
        back = np.argsort(order[once], kind="stable")
        token, key, own, first, size, other = (x[back] for x in (token, key, own, first, size, other))
        for start in range(0, len(token), 1 << 16):
            cut = slice(start, start + (1 << 16))
            lead = first[cut]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.where(lead, token[cut], own[cut])), pa.array(token[cut], mask=lead), pa.array(key[cut]), pa.array(size[cut]), pa.array(other[cut], mask=lead)],
                names=["place", "token", "key", "size", "other"],
            )

    return run


def _rejoined(percent: int):
    """`_joined` over the batches of a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        join, held = _joined(percent), []
        for batch in batches:
            held.append([batch.column(c).to_numpy() for c in ("token", "key", "n")])
            if sum(len(h[0]) for h in held) >= CHUNK:
                yield from join(*(np.concatenate(c) for c in zip(*held)))
                held = []
        if held:
            yield from join(*(np.concatenate(c) for c in zip(*held)))

    return run


def _partners(postings: DataFrame) -> DataFrame:
    """token, key, n and `before` of the rows of POSTING whose token stands in another set of a size that may link.

    A place holds a row a task and bin at most; neighbours by bin are partners, and copies of a set are none.
    `before`: the partner that a row is joined with; the partners of a token are so all connected.
    """
    rows = postings.select("place", F.coalesce("token", "place").alias("token"), "key", F.shiftright("size", 10).cast("int").alias("n"), F.shiftright(F.col("size").bitwiseAND(1022), 1).cast("int").alias("bin"), "other", (F.col("size").bitwiseAND(1) == 1).alias("many"))
    by_bin = W.partitionBy("place").orderBy("bin", "key")
    once = rows.withColumn("_p", F.lag("key").over(by_bin)).withColumn("_q", F.max("many").over(W.partitionBy("place", "bin", "key")))
    near = once.filter("other is not null or _p is null or _p <> key").select(
        "token", "key", "n", "bin", "other", F.col("_q").alias("many"),
        F.lag("key").over(by_bin).alias("_l"), F.lag("bin").over(by_bin).alias("_lb"), F.lead("bin").over(by_bin).alias("_rb"),
    )
    left, right = F.col("bin") - F.col("_lb") <= 1, F.col("_rb") - F.col("bin") <= 1
    before = F.when(F.col("other").isNotNull(), F.col("other")).when(left, F.col("_l"))
    return near.filter(F.col("other").isNotNull() | F.col("many") | left | right).select("token", "key", "n", before.alias("before"))


def _candidates(postings: DataFrame, percent: int, share: int, rounds: int = 3) -> DataFrame:
    """Pairs (u, v) of set keys that connect every two sets which may link; `postings`: rows of POSTING.

    A set with fewer shared tokens than a link needs goes, and with it what others shared with it alone; after
    `rounds` of that, what is left of each token is connected. No posting is written out as pairs.
    """
    left = staged(_partners(postings), "postings")
    for _ in range(rounds - 1):
        need = F.floor(F.ceil(F.col("n") * percent / 100) * share / 100) + 1
        once = left.groupBy("key", "token").agg(F.first("n").alias("n"))
        enough = once.groupBy("key").agg(F.count("*").alias("shared"), F.first("n").alias("n")).filter(F.col("shared") >= need).select("key")
        kept = left.select("token", "key", "n").join(enough, "key")
        last, left = left, staged(_partners(kept.mapInArrow(_rejoined(percent), POSTING)), "postings")
        unstage(last)
    return left.filter("before is not null").select(F.col("key").alias("u"), F.col("before").alias("v")).distinct()


#: Columns of a block of the product, and how many rows a column must have to be taken as a dense one.
COLUMNS, DENSE = 4096, 24


def _sparse_counts(rows: np.ndarray, column: np.ndarray, left: np.ndarray, right: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """Overlaps that a block of columns adds: each column's rows on the left by its rows on the right.

    `rows` and `column` are the incidence, in order of column; `left` and `right` give a row's place in the tile, -1 for none.
    """
    total = np.zeros(shape[0] * shape[1], dtype=np.int64)
    one, two = np.nonzero(left[rows] >= 0)[0], np.nonzero(right[rows] >= 0)[0]
    a, b = column[one], column[two]
    lo, hi = np.searchsorted(b, a, side="left"), np.searchsorted(b, a, side="right")
    n = hi - lo
    if not n.sum():
        return total.reshape(shape)
    at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    cells = np.repeat(left[rows[one]], n) * shape[1] + right[rows[two[at]]]
    return np.bincount(cells, minlength=len(total)).reshape(shape)


def product_links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between rows `left` and rows `right` (indices into `sets`).

    The incidence (columns of one row left out, rarest columns first) is multiplied in blocks of columns. Rare columns
    are accumulated from their postings, columns with very many rows by a dense block; after each block the pairs whose
    remaining columns leave them below the bound that their sizes give are dropped.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    rows = np.repeat(np.arange(len(sets)), sizes)
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    by_rarity = np.argsort(times, kind="stable")
    place = np.empty(len(times), dtype=np.int64)
    place[by_rarity] = np.arange(len(times))
    single = int((times == 1).sum())
    column = place[column] - single
    shared = column >= 0
    rows, column = rows[shared], column[shared]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    width, rare = len(times) - single, int((times <= DENSE).sum()) - single
    a, b = sizes[left][:, None], sizes[right][None, :]
    bound = -(-(a + b) * percent // (100 + percent))
    alive = (np.minimum(a, b) * 100 >= np.maximum(a, b) * percent) & (left[:, None] != right[None, :])
    rest = np.bincount(rows, minlength=len(sets))
    overlap = np.zeros(alive.shape, dtype=np.int64)
    of_left, of_right = (np.full(len(sets), -1, dtype=np.int64) for _ in range(2))
    of_left[left], of_right[right] = np.arange(len(left)), np.arange(len(right))
    edges = sorted({*range(0, width, COLUMNS), rare, width})
    for start, end in zip(edges, edges[1:]):
        if not alive.any():
            break
        lo, hi = np.searchsorted(column, (start, end))
        if start < rare:
            overlap += _sparse_counts(rows[lo:hi], column[lo:hi], of_left, of_right, alive.shape)
        else:
            block = np.zeros((len(sets), end - start), dtype=np.float32)
            block[rows[lo:hi], column[lo:hi] - start] = 1
            overlap += np.rint(block[left] @ block[right].T).astype(np.int64)
        rest = rest - np.bincount(rows[lo:hi], minlength=len(sets))
        alive &= overlap + np.minimum(rest[left][:, None], rest[right][None, :]) >= bound
    linked = alive & (overlap * 100 >= (a + b - overlap) * percent)
    root = list(range(len(sets)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    forest = []
    for i, j in zip(*np.nonzero(linked)):
        x, y = find(int(left[i])), find(int(right[j]))
        if x != y:
            root[max(x, y)] = min(x, y)
            forest.append((int(left[i]), int(right[j])))
    return forest


#: Rows that a task of the product is to get, over all its pairs of tiles.
CELL_ROWS = 1024
#: Rows of a tile that are multiplied at once.
PART_ROWS = 1024


def tile_links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int, part_rows: int = PART_ROWS) -> list[tuple[int, int]]:
    """`product_links` of tiles of any number of rows: part by part, so that no matrix has more than `part_rows` rows a side."""
    root = list(range(len(sets)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    forest, same = [], np.array_equal(left, right)
    for i in range(0, len(left), part_rows):
        for j in range(i if same else 0, len(right), part_rows):
            one, two = left[i : i + part_rows], right[j : j + part_rows]
            held, at = np.unique(np.concatenate([one, two]), return_inverse=True)
            for x, y in product_links([sets[k] for k in held], at[: len(one)], at[len(one) :], percent):
                u, v = int(held[x]), int(held[y])
                a, b = find(u), find(v)
                if a != b:
                    root[max(a, b)] = min(a, b)
                    forest.append((u, v))
    return forest


def _cell(size: int, percent: int):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        _, first, second = key
        shingles = Shingles(size)
        ids, tile = frame["key"].to_numpy(), frame["tile"].to_numpy()
        sets = [shingles.of(bytes(data)) for data in frame["data"]]
        left, right = np.nonzero(tile == first)[0], np.nonzero(tile == second)[0]
        links = tile_links(sets, left, right, percent) if len(left) and len(right) else []
        return pd.DataFrame({"u": [ids[i] for i, _ in links], "v": [ids[j] for _, j in links]}, dtype="int64")

    return run


def tiled(members: DataFrame, percent: int, tile_rows: int, tile_shingles: int) -> DataFrame:
    """`members` (key, block, n_shingles, ...) with `tile` and `others`, the tiles that each must meet.

    Members of a block are dealt over tiles by bin of size and, within a bin, by a hash of their key: at most about
    `tile_rows` members and `tile_shingles` shingles a tile, whatever the block (a set larger than that is alone). Tiles of bins
    that are further apart than a link allows never meet. A block that fits in one tile is one.
    """
    bin_of = F.floor(F.log(F.col("n_shingles").cast("double")) / (math.log(100 / percent) * (1 + 1e-6) + 1e-12)).cast("int")
    binned = members.withColumn("bin", bin_of)
    extent = binned.groupBy("block", "bin").agg(F.count("*").alias("rows"), F.sum("n_shingles").alias("total"))
    whole = W.partitionBy("block")
    parts = F.greatest(F.ceil(F.col("rows") / tile_rows), F.ceil(F.col("total") / tile_shingles)).cast("int")
    fits = (F.sum("rows").over(whole) <= tile_rows) & (F.sum("total").over(whole) <= tile_shingles)
    plan = extent.select("block", "bin", F.when(fits, F.lit(0)).otherwise(F.col("bin")).alias("level"), F.when(fits, F.lit(1)).otherwise(parts).alias("parts"))
    near = plan.select("block", F.col("level").alias("_level"), F.col("parts").alias("_parts")).distinct()
    meets = plan.join(near, "block").filter(F.abs(F.col("level") - F.col("_level")) <= 1).groupBy("block", "bin", "level", "parts").agg(
        F.flatten(F.collect_list(F.transform(F.sequence(F.lit(0), F.col("_parts") - 1), lambda k: _tile(F.col("_level"), k)))).alias("others")
    )
    own = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
    return binned.join(meets, ["block", "bin"]).select(*members.columns, _tile(F.col("level"), own).alias("tile"), "others")


def _tile(level: Column, part: Column) -> Column:
    return F.shiftleft(level.cast("long"), 40) + part


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80, share: int = 10, tile_rows: int = 128, tile_shingles: int = 1_000_000) -> DataFrame:
    """Links documents of `docs` (doc_id, text) whose shingle sets have a Jaccard similarity of percent % or more.

    Returns per document: doc_id, n_shingles (0 for null and blank texts, which link with nothing), class_id (the
    smallest doc_id with the same set) and component_id (the smallest doc_id reachable by links; null only for sets
    that no document with a doc_id reaches). Every link between different sets is checked on the whole sets; equal sets
    are one class and never compared. Very long texts are read whole: a task holds a tile's sets, and a set that
    exceeds a tile is a tile of its own. Repeated rows are copies, and rows that share a doc_id with other texts are
    members by their text like any other; ties in rarity go by hash; other columns of `docs` are ignored, whatever
    their names; an empty table gives no rows. Sets are compared by 64-bit hashes of shingles.

    1. Equal sets are grouped by a hash. 2. Sets are ordered rarest shingle first (by counts over all documents in
    2^20 buckets; any order is exact, this one keeps common passages out). A set whose size-derived prefix shares less
    than a link needs is left out; the others fall in blocks that no link leaves. A token's sets are joined within each
    task before they are shuffled, so that none is hot. Texts are read a third time for the blocks alone. 3. Blocks are
    cut into tiles of bounded rows and shingles, the sparse product of each pair of tiles that sizes allow is one task, which
    multiplies PART_ROWS rows at a time and returns a spanning forest of its links.
    """
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("data"))
    summary, schema = _summaries(size)
    made = staged(rows.mapInArrow(tidy(summary), schema), "summaries")
    parts = made.filter("counts is not null").select(F.col("n_shingles").alias("part"), F.col("counts").alias("data"))
    load = np.minimum(_gathered(parts, np.int64, np.add, BUCKETS), np.iinfo(np.int32).max).astype(np.int32)

    sized = made.filter("counts is null").select("doc_id", "n_shingles", "key")
    full = sized.filter("key is not null")
    firsts = staged(full.groupBy("key").agg(F.min("doc_id").alias("class_id"), F.first("n_shingles").alias("n_shingles")), "classes")

    near = components(_candidates(rows.mapInArrow(tidy(_prefixes(size, percent, share, load)), POSTING), percent, share), "blocks")
    blocks = near.select(F.col("node").alias("key"), F.col("component").alias("block")).join(firsts.select("key", "class_id", "n_shingles"), "key")
    placed = staged(tiled(blocks, percent, tile_rows, tile_shingles), "tiles")
    wanted = placed.select(F.col("class_id").alias("doc_id"), "key", "block", "tile", "others")
    held = texts_of(rows, wanted, size)
    known = held.filter("doc_id is not null").join(wanted.filter("doc_id is not null"), ["doc_id", "key"])
    if not wanted.filter("doc_id is null").isEmpty():
        known = known.unionByName(held.filter("doc_id is null").join(wanted.filter("doc_id is null").drop("doc_id"), "key").select(*known.columns))
    if _repeats(full):
        known = known.dropDuplicates(["key"])
    cells = known.withColumn("other", F.explode("others")).select("key", "block", "tile", F.least("tile", "other").alias("first"), F.greatest("tile", "other").alias("second"), "data")
    few = -(-(placed.agg(F.sum(F.size("others"))).first()[0] or 1) // CELL_ROWS)
    links = cells.repartition(min(100_000, few), "block", "first", "second").groupBy("block", "first", "second").applyInPandas(_cell(size, percent), "u long, v long")
    merged = components(links, "links")

    joined = firsts.join(merged, F.col("key") == F.col("node"), "left").select("key", "class_id", F.coalesce("component", "key").alias("root"))
    least = joined.groupBy("root").agg(F.min("class_id").alias("component_id"))
    classes = joined.join(least, "root").select("key", "class_id", "component_id")
    return full.join(classes, "key").select("doc_id", "n_shingles", "class_id", "component_id").unionByName(
        sized.filter("key is null").select("doc_id", "n_shingles", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id"))
    )


def _repeats(full: DataFrame) -> bool:
    """Whether rows share doc_id and set."""
    return not full.groupBy("doc_id", "key").count().filter("count > 1").isEmpty()
