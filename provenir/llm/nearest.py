"""Approximate nearest neighbours by inner product: balanced posting lists, a graph over their centroids, distance-ratio pruning."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from .common import staged, tidy
from .embeddings import _bytes_of

LARGEST = float(np.finfo(np.float64).max)
#: Neighbours of a centroid in the graph, centroids that a search looks at whatever the ratio, and centroids for one entry.
DEGREE, LEAST_SEEN, ENTRY_EACH = 24, 16, 32


def _double(raws: list[bytes], dims: int) -> np.ndarray:
    kind = np.float32 if len(raws[0]) == 4 * dims else np.float64
    return np.frombuffer(b"".join(raws), dtype=kind).reshape(len(raws), dims).astype(np.float64)


def _usable(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that take part: vec_id, dimensions, the vector as bytes, their hash and the vector's norm."""
    for batch in batches:
        values = batch.column("embedding").type.value_type
        width = 4 if pa.types.is_float32(values) else 8
        rows = [(i, v) for i, v in zip(batch.column("vec_id").to_pylist(), _bytes_of(batch.column("embedding"))) if i is not None and v is not None]
        norms = []
        for _, v in rows:
            x = np.frombuffer(v, dtype=np.float32 if width == 4 else np.float64).astype(np.float64)
            top = np.abs(x).max()
            with np.errstate(over="ignore"):
                norms.append(min(float(top * np.linalg.norm(x / top)), LARGEST))
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in rows], pa.int64()), pa.array([len(v) // width for _, v in rows], pa.int32()), pa.array([v for _, v in rows], pa.binary()),
             pa.array([hashlib.blake2b(v, digest_size=16).digest() for _, v in rows], pa.binary()), pa.array(norms, pa.float64())],
            names=["vec_id", "dims", "raw", "hash", "norm"],
        )


def lifted(x: np.ndarray, largest: float) -> np.ndarray:
    """Vectors over the largest norm, with one more component that makes each a unit vector: for any query the order by
    distance is then the order by inner product."""
    u = x / largest
    return np.column_stack([u, np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", u, u)))])


def lifted_query(x: np.ndarray) -> np.ndarray:
    """Queries as unit vectors (their length does not change an order), with 0 for the component that `lifted` adds."""
    u = x / np.abs(x).max(axis=1, keepdims=True)
    return np.column_stack([u / np.linalg.norm(u, axis=1, keepdims=True), np.zeros(len(u))])


def balanced_centroids(x: np.ndarray, lists: int) -> np.ndarray:
    """Means of `lists` (a power of two) clusters: each is cut in two by two-means, at a margin that leaves 40 % on either side."""
    if lists == 1 or len(x) < 2:
        return x.mean(0, keepdims=True)
    middle = x.mean(0)
    far = x[np.argmax(((x - middle) ** 2).sum(1))]
    way = far - x[np.argmax(((x - far) ** 2).sum(1))]
    for _ in range(6):
        side = (x - middle) @ way
        low, high = np.quantile(side, (0.4, 0.6))
        right = side > min(max(0.0, low), high)
        if right.all() or not right.any():
            right = np.arange(len(x)) % 2 == 0
        a, b = x[right].mean(0), x[~right].mean(0)
        middle, way = (a + b) / 2, a - b
    return np.concatenate([balanced_centroids(x[right], lists // 2), balanced_centroids(x[~right], lists // 2)])


@dataclass
class Index:
    """Centroids in the order of their tree, their graph, the largest norm, and the ratio of distances up to which lists are
    searched. A query whose nearest list is nearer than `floor` counts as that far: beside a tight group all else is far."""

    centroids: np.ndarray
    graph: np.ndarray
    largest: float
    ratio: float = 1.0
    floor: float = 0.0

    @classmethod
    def of(cls, centroids: np.ndarray, largest: float) -> Index:
        near = np.empty((len(centroids), min(DEGREE, len(centroids))), dtype=np.int32)
        squares = (centroids**2).sum(1)
        for at in range(0, len(centroids), 1024):
            far = squares - 2 * centroids[at : at + 1024] @ centroids.T
            near[at : at + 1024] = np.argsort(far, axis=1, kind="stable")[:, : near.shape[1]]
        return cls(centroids, near, largest)

    def distances(self, x: np.ndarray, ratio: float, floor: float = 0.0, least: int = LEAST_SEEN) -> np.ndarray:
        """Distances to the centroids that a search of the graph meets (infinite for the others), a row for each of `x`.

        From entries spread over the tree, every centroid within `ratio` times the smallest distance so far (`floor` at least), or among
        the `least` nearest, is expanded to its neighbours, until none is left.
        """
        n, k = len(x), len(self.centroids)
        found = np.full((n, k), np.inf)
        done = np.zeros((n, k), dtype=bool)
        entries = np.arange(0, k, ENTRY_EACH)
        found[:, entries] = np.sqrt(np.maximum(0.0, (x**2).sum(1)[:, None] - 2 * x @ self.centroids[entries].T + (self.centroids[entries] ** 2).sum(1)))
        while True:
            nearest_of = np.partition(found, min(least, k) - 1, axis=1)[:, min(least, k) - 1]
            bound = np.maximum(np.maximum(found.min(1), floor) * ratio, np.where(np.isfinite(nearest_of), nearest_of, found.min(1)))
            row, node = np.nonzero((found <= bound[:, None]) & ~done)
            if not len(row):
                return found
            done[row, node] = True
            width = self.graph.shape[1]
            fresh = np.unique(np.repeat(row, width) * k + self.graph[node].ravel())
            row, node = fresh // k, fresh % k
            new = np.isinf(found[row, node])
            row, node = row[new], node[new]
            for at in range(0, len(row), 65536):
                r, c = row[at : at + 65536], node[at : at + 65536]
                gap = x[r] - self.centroids[c]
                found[r, c] = np.sqrt(np.einsum("ij,ij->i", gap, gap))

    def homes(self, x: np.ndarray, boundary: float, replicas: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, list): the nearest list of each vector, and of those within `boundary` times its distance the ones that lie
        in other directions: a list is left out if one already taken is nearer to it than the vector is."""
        width = min(len(self.centroids), 2 * replicas)
        found = self.distances(x, 1.0, least=width)
        lists = np.argpartition(found, width - 1, axis=1)[:, :width]
        away = np.take_along_axis(found, lists, 1)
        order = np.lexsort((lists, away))
        lists, away = np.take_along_axis(lists, order, 1), np.take_along_axis(away, order, 1)
        taken = np.zeros_like(away, dtype=bool)
        taken[:, 0] = True
        for j in range(1, width):
            fits = np.isfinite(away[:, j]) & (away[:, j] <= boundary * away[:, 0]) & (taken.sum(1) < replicas)
            for i in range(j):
                at = np.nonzero(fits & taken[:, i])[0]
                gap = self.centroids[lists[at, i]] - self.centroids[lists[at, j]]
                fits[at[np.sqrt(np.einsum("ij,ij->i", gap, gap)) <= away[at, j]]] = False
            taken[:, j] = fits
        row, column = np.nonzero(taken)
        return row, lists[row, column]

    def searched(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list): the lists that a query is compared with, however many are within the ratio."""
        found = self.distances(q, self.ratio, self.floor)
        return np.nonzero(found <= self.ratio * np.maximum(found.min(1), self.floor)[:, None] + 1e-12)

    def ratio_for(self, queries: np.ndarray, known: np.ndarray, lists: tuple[np.ndarray, np.ndarray], wanted: int, recall: float) -> float:
        """The smallest ratio at which `queries` (places in `known`) reach the share `recall` of their `wanted` nearest others,
        by the `lists` that these are in."""
        needed = []
        for i, q in zip(queries, lifted_query(known[queries, :-1]) if len(queries) else []):
            away = np.sqrt(np.maximum(0.0, ((self.centroids - q) ** 2).sum(1)))
            best = np.full(len(known), np.inf)
            np.minimum.at(best, lists[0], away[lists[1]])
            score = known @ q
            score[i] = -np.inf
            needed.extend(best[np.argsort(-score, kind="stable")[: min(wanted, len(known) - 1)]] / max(away.min(), self.floor))
        return float(max(1.0, np.quantile(needed, recall))) if needed else 1.0


def fit(sample: np.ndarray, rows: int, largest: float, list_rows: int, neighbours: int, recall: float, boundary: float, replicas: int) -> Index:
    """An index from a bounded sample (lifted vectors in an order of no meaning) of `rows` vectors: one in eight is held
    back from the centroids. The ratio is the larger of those that held-back and fitted rows need."""
    wanted = max(1.0, min(rows / list_rows, len(sample) / 8))
    held = np.arange(len(sample)) % 8 == 7
    index = Index.of(balanced_centroids(sample[~held], 1 << int(np.ceil(np.log2(wanted)))), largest)
    # the nearest of all rows are, in the sample, a share of that number; at least four, which errs to more lists
    near = int(min(neighbours, max(4, np.ceil(neighbours * len(sample) / rows))))
    homes = tuple(np.concatenate(x) for x in zip(*((r + at, c) for at in range(0, len(sample), 256) for r, c in [index.homes(sample[at : at + 256], boundary, replicas)])))
    real = np.linalg.norm(sample[:, :-1], axis=1) > 0
    index.floor = max(float(np.median(np.concatenate([index.distances(sample[at : at + 256], 1.0).min(1) for at in range(0, len(sample), 256)]))), 1e-9)
    index.ratio = max(index.ratio_for(np.nonzero(some & real)[0][:256], sample, homes, near, recall) for some in (held, ~held))
    return index


def _placed(indexes: dict[int, Index], query: bool, carried: list[str], boundary: float, replicas: int) -> Callable:
    """Rows with the lists they belong to (or, queries, search), a row for each."""

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.slice(at, 256)
                dims = batch.column("dims").to_numpy()
                for d in np.unique(dims):
                    rows = np.nonzero(dims == d)[0]
                    index = indexes[int(d)]
                    x = _double(batch.column("raw").take(pa.array(rows)).to_pylist(), int(d))
                    row, lists = index.searched(lifted_query(x)) if query else index.homes(lifted(x, index.largest), boundary, replicas)
                    told = batch.select(carried).take(pa.array(rows[row]))
                    yield pa.RecordBatch.from_arrays([*told.columns, pa.array(lists, pa.int32())], names=[*carried, "list"])

    return run


def _best(row: np.ndarray, order: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the first `most` of each row by (order, id), row after row."""
    at = np.lexsort((ids, order, row))
    first = np.searchsorted(row[at], row[at], side="left")
    return at[np.arange(len(at)) - first < most]


def _cell(most: int, step: int = 256) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The `most` nearest rows of a part of a list for a chunk of its queries; classes are compared, their members told."""

    def run(index: pa.Table, asked: pa.Table) -> pa.Table:
        hashes, ends, orders, found = [], [0], [], []
        if len(index) and len(asked):
            d = index.column("dims")[0].as_py()
            x = _double(index.column("raw").to_pylist(), d)
            members = index.column("members").combine_chunks()
            flat, starts = members.values.to_numpy(), members.offsets.to_numpy()
            flat, starts = flat[starts[0] : starts[-1]], starts - starts[0]
            size, least = np.diff(starts), flat[starts[:-1]]
            u = x / max(np.abs(x).max(), 1e-300)
            for at in range(0, len(asked), step):
                part = asked.slice(at, step)
                q = _double(part.column("raw").to_pylist(), d)
                with np.errstate(all="ignore"):
                    near = (q / np.abs(q).max(axis=1, keepdims=True)) @ u.T
                    cut = np.partition(near, len(x) - most, axis=1)[:, len(x) - most] - 1e-9 * d if len(x) > most else np.full(len(q), -np.inf)
                    row, column = np.nonzero(near >= cut[:, None])
                    order = -(q[row] * x[column]).sum(1)
                keep = _best(row, order, least[column], most)
                row, column, order = row[keep], column[keep], order[keep]
                n = size[column]
                inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                ids = flat[np.repeat(starts[column], n) + inner]
                row, order = np.repeat(row, n), np.repeat(order, n)
                keep = _best(row, order, ids, most)
                hashes.extend(part.column("hash").to_pylist())
                ends.extend(ends[-1] + np.cumsum(np.bincount(row[keep], minlength=len(part))))
                orders.append(order[keep])
                found.append(ids[keep])
        pairs = pa.StructArray.from_arrays([pa.array(np.concatenate(orders or [np.zeros(0)])), pa.array(np.concatenate(found or [np.zeros(0, np.int64)]))], names=["away", "vec_id"])
        return pa.table({"hash": pa.array(hashes, pa.binary()), "best": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)})

    return run


def nearest(
    vectors: DataFrame, queries: Column | None = None, neighbours: int = 20, list_rows: int = 512, most_sampled: int = 32_768, recall: float = 0.98,
    boundary: float = 1.15, replicas: int = 8, part_rows: int = 8192, chunk_rows: int = 4096,
) -> DataFrame:
    """The `neighbours` rows of `vectors` (vec_id, embedding) of largest inner product for each row that `queries` (a
    condition over vec_id) picks: query_id, rank (from 1), vec_id, score.

    A query's own vec_id is no candidate; ties go to the smaller vec_id; scores are double-precision inner products of the
    vectors as given. Fewer candidates give fewer rows. Vectors that are null, empty, zero or hold a null or non-finite
    component, and rows without vec_id, take no part; only vectors of one length are compared. Repeated rows count once; a
    vec_id with several vectors is a candidate with each, and a query with each (its ranks are then told for each vector).
    Other columns are ignored, whatever their names; an empty table gives no rows. Products beyond a double are infinite.

    Equal vectors form a class, compared once: of its rows only the `neighbours` + 1 smallest vec_id can be told. The index
    is fitted on a sample of at most about `most_sampled` classes (a documented bound), and every class is put in its
    nearest list and, near a boundary, in up to `replicas` lists in all; lists number about one for `list_rows` classes and
    one for 8 of the sample at most. Queries find lists by the graph and search every one within a ratio of distances at
    which the sample reaches `recall`; a list beyond `part_rows` classes or `chunk_rows` queries is cut
    into as many tasks' shares as it needs.
    """
    asked = F.col("vec_id") % 20 == 0 if queries is None else queries
    taken = vectors.select("vec_id", "embedding").mapInArrow(tidy(_usable), "vec_id long, dims int, raw binary, hash binary, norm double")
    rows = staged(taken.dropDuplicates(["vec_id", "hash"]), "rows")
    order = W.partitionBy("hash").orderBy("vec_id")
    few = rows.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= neighbours + 1)
    classes = staged(few.groupBy("hash").agg(F.first("dims").alias("dims"), F.first("raw").alias("raw"), F.sort_array(F.collect_list("vec_id")).alias("members"), F.first("norm").alias("norm")), "classes")
    wanted = rows.filter(asked).select("vec_id", "hash")
    sought = classes.join(wanted.select("hash").distinct(), "hash", "left_semi")

    indexes = {}
    for d in classes.groupBy("dims").agg(F.count("*").alias("n"), F.max("norm").alias("largest")).collect():
        share = min(1.0, most_sampled / d["n"])
        picked = classes.filter((F.col("dims") == d["dims"]) & (F.xxhash64("hash") % 1_000_003 < int(share * 1_000_003))) if share < 1 else classes.filter(F.col("dims") == d["dims"])
        some = picked.select("raw", "hash").toArrow().sort_by("hash")
        if not len(some):
            some = classes.filter(F.col("dims") == d["dims"]).select("raw", "hash").limit(1).toArrow()
        sample = lifted(_double(some.column("raw").to_pylist(), d["dims"]), d["largest"])
        indexes[d["dims"]] = fit(sample, d["n"], d["largest"], list_rows, neighbours, recall, boundary, replicas)

    stored = staged(classes.select("dims", "raw", "members").mapInArrow(_placed(indexes, False, ["dims", "raw", "members"], boundary, replicas), "dims int, raw binary, members array<long>, list int"), "lists")
    searching = staged(sought.select("dims", "raw", "hash").mapInArrow(_placed(indexes, True, ["dims", "raw", "hash"], boundary, replicas), "dims int, raw binary, hash binary, list int"), "searches")
    # one row for each list, whose number is bounded by the sample
    parts = stored.groupBy("dims", "list").agg(F.ceil(F.count("*") / part_rows).cast("int").alias("parts"))
    chunks = searching.groupBy("dims", "list").agg(F.ceil(F.count("*") / chunk_rows).cast("int").alias("chunks"))
    shares = F.broadcast(staged(parts.join(chunks, ["dims", "list"]), "shares"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = stored.join(shares, ["dims", "list"]).select("dims", "list", F.pmod(F.xxhash64("raw"), F.col("parts")).cast("int").alias("part"), each("chunks").alias("chunk"), "raw", "members")
    right = searching.join(shares, ["dims", "list"]).select("dims", "list", each("parts").alias("part"), F.pmod(F.xxhash64("hash"), F.col("chunks")).cast("int").alias("chunk"), "raw", "hash")
    keys = ["dims", "list", "part", "chunk"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_cell(neighbours + 1), "hash binary, best array<struct<away double, vec_id long>>")
    merged = found.groupBy("hash").agg(F.flatten(F.collect_list("best")).alias("all")).withColumn("all", F.sort_array("all"))
    # a class in several lists is told by each, with one score: equal entries stand side by side
    once = F.filter("all", lambda b, i: (i == 0) | (b != F.col("all")[F.greatest(i - 1, F.lit(0))]))
    best = merged.select("hash", F.slice(once, 1, neighbours + 1).alias("best"))
    others = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, neighbours)
    told = wanted.withColumnRenamed("vec_id", "query_id").join(best, "hash").select("query_id", F.posexplode(others).alias("at", "near"))
    return told.select("query_id", (F.col("at") + 1).alias("rank"), F.col("near.vec_id").alias("vec_id"), (-F.col("near.away")).alias("score"))
