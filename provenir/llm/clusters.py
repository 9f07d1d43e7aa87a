"""Centroid clustering on integers: segment norms bound distances from below, only what they leave open is computed exactly."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, tidy

#: A squared distance of `DIMS` components up to this size fits a long.
DIMS, MOST = 64, 1 << 27
SCALE, SEGMENT = 256, 8


def segment_norms(x: np.ndarray) -> np.ndarray:
    """Norms of the runs of `SEGMENT` components of integer vectors, a row each."""
    parts = x.reshape(len(x), DIMS // SEGMENT, SEGMENT).astype(np.float64)
    return np.sqrt(np.einsum("ijk,ijk->ij", parts, parts))


def assigned(x: np.ndarray, norms: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance, exact distances computed) of integer vectors; ties go to the smaller number.

    By Cauchy-Schwarz no segment's product exceeds the product of its norms, so the squared differences of norms add up to
    a lower bound of the squared distance. The exact distance to the centroid of least bound rules out all others with a
    larger bound; what is left is computed in integers.
    """
    every = np.arange(len(x))
    bound = ((norms[:, None, :] - segment_norms(centroids)[None, :, :]) ** 2).sum(2)
    bound = np.maximum(0.0, bound * (1 - 1e-12) - 1e-12 * (norms**2).sum(1)[:, None] - 1.0)  # below what rounding could add
    first = bound.argmin(1)
    exact = np.full(bound.shape, np.iinfo(np.int64).max)
    exact[every, first] = ((x - centroids[first]) ** 2).sum(1)
    row, column = np.nonzero(bound <= exact[every, first].astype(np.float64)[:, None])
    open_ = column != first[row]
    row, column = row[open_], column[open_]
    for at in range(0, len(row), 32768):
        r, c = row[at : at + 32768], column[at : at + 32768]
        exact[r, c] = ((x[r] - centroids[c]) ** 2).sum(1)
    cluster = exact.argmin(1)
    return cluster, exact[every, cluster], len(row) + len(x)


def _whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The vectors that are kept, as integers, with their segment norms and the hash that picks the first centroids."""
    for batch in batches:
        ids, rows = [], []
        for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist()):
            if v is None or len(v) != DIMS or any(e is None for e in v):
                continue
            x = np.asarray(v, dtype=np.float64)
            if np.abs(x).max() <= MOST / SCALE - 1:  # false for what is not finite
                ids.append(i)
                rows.append(np.floor(SCALE * x).astype(np.int32))
        x = np.stack(rows) if rows else np.zeros((0, DIMS), np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([r.tobytes() for r in x], pa.binary()), pa.array([r.tobytes() for r in segment_norms(x)], pa.binary()),
             pa.array([None if i is None else hashlib.sha256(f"2:{i}".encode()).hexdigest() for i in ids], pa.string())],
            names=["vec_id", "ints", "norms", "hash"],
        )


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    ints = np.frombuffer(b"".join(batch.column("ints").to_pylist()), dtype=np.int32).reshape(len(batch), DIMS).astype(np.int64)
    return ints, np.frombuffer(b"".join(batch.column("norms").to_pylist())).reshape(len(batch), DIMS // SEGMENT)


def _sums(centroids: np.ndarray) -> Callable:
    """Per task and cluster: number of vectors and the sum of each component."""

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), DIMS), np.int64)
        for whole in batches:
            for at in range(0, len(whole), 2048):
                ints, norms = _arrays(whole.slice(at, 2048))
                cluster, _, _ = assigned(ints, norms, centroids)
                n += np.bincount(cluster, minlength=len(centroids))
                np.add.at(total, cluster, ints)
        met = np.nonzero(n)[0]
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(n[met]), pa.array(total[met].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "total"])

    return run


def _told(centroids: np.ndarray) -> Callable:
    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 2048):
                batch = whole.slice(at, 2048)
                cluster, distance, _ = assigned(*_arrays(batch), centroids)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return run


def cluster(vectors: DataFrame, clusters: int = 40, rounds: int = 5) -> DataFrame:
    """Lloyd's rounds in whole numbers over `vectors` (vec_id, embedding): vec_id, cluster, distance (squared), cluster_inertia,
    inertia, centroid_sha256, a row for each vector of 64 components that are neither null nor beyond finite numbers.

    Each component x becomes floor(256 * x). The first centroids are the vectors of smallest sha256 of `2:<vec_id>`, in
    that order (rows that share a vec_id by their integers; rows without vec_id are never picked). A round gives every
    vector to its nearest centroid (ties: smaller number) and replaces each non-empty one by floor(sum / count) of each
    component. Vectors with a component beyond 2^19 are left out like infinite ones: their distances would not fit a long.
    Fewer vectors than clusters give fewer centroids; an empty table, or no vec_id at all, gives no rows. Repeated rows are vectors of
    their own; other columns are ignored, whatever their names. A sum beyond a long is null.

    A round is one pass whose tasks add up their clusters: `clusters` rows a task are shuffled and `clusters` rows reach
    the driver, whatever the input, so no cluster is gathered anywhere.
    """
    kept = staged(vectors.select("vec_id", "embedding").mapInArrow(tidy(_whole), "vec_id long, ints binary, norms binary, hash string"), "integers")
    first = kept.filter("hash is not null").orderBy("hash", "ints").limit(clusters).select("ints").collect()
    if not first:
        return vectors.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = np.stack([np.frombuffer(bytes(r["ints"]), dtype=np.int32).astype(np.int64) for r in first])
    part = kept.select("ints", "norms")
    for _ in range(rounds):
        sums = part.mapInArrow(_sums(centroids), "cluster int, n long, total array<long>")
        added = sums.groupBy("cluster").agg(F.sum("n").alias("n"), *(F.sum(F.col("total")[k]).alias(f"c{k}") for k in range(DIMS)))
        for r in added.collect():
            centroids[r["cluster"]] = [r[f"c{k}"] // r["n"] for k in range(DIMS)]
    told = staged(kept.select("vec_id", "ints", "norms").mapInArrow(_told(centroids), "vec_id long, cluster int, distance long"), "assigned")
    as_long = lambda c: F.expr(f"try_cast({c} as bigint)")
    inertia = told.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    whole = sum(int(r["total"]) for r in inertia)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    # one row for each cluster
    known = told.sparkSession.createDataFrame([(r["cluster"], r["total"], str(whole), digests[r["cluster"]]) for r in inertia], "cluster int, total decimal(38,0), whole string, centroid_sha256 string")
    small = F.broadcast(known.select("cluster", as_long("total").alias("cluster_inertia"), as_long("whole").alias("inertia"), "centroid_sha256"))
    return told.join(small, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
