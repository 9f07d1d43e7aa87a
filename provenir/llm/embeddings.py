"""Embedding near-dedup: PCA-ordered tiles, leading dimensions first, residuals bounded by suffix norms."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from .common import components, staged

SLACK = 1e-9


def _vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Double vectors; None where null, empty, zero or holding a null or a number that is not finite."""
    out: list[np.ndarray | None] = []
    for x in column:
        values = x.as_py() if x.is_valid else None
        if not values or any(v is None for v in values):
            out.append(None)
            continue
        v = np.asarray(values, dtype=np.float64)
        out.append(v if np.isfinite(v).all() and v.any() else None)
    return out


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max()
    return v / np.sqrt(np.dot(v, v))


def _bytes_of(column: pa.Array) -> list[bytes | None]:
    """The components of usable vectors as bytes, of 4-byte numbers where the column holds such and of doubles else."""
    kind = np.float32 if pa.types.is_float32(column.type.value_type) else np.float64
    return [None if v is None else (v + 0.0).astype(kind).tobytes() for v in _vectors(column)]


def unit_of(raw: bytes, dims: int) -> np.ndarray:
    """The unit vector (double) of what `_bytes_of` gives."""
    return _unit(np.frombuffer(raw, dtype=np.float32 if len(raw) == 4 * dims else np.float64).astype(np.float64))


def _usable(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, label, dimensions, the vector as bytes and their hash (null: links with nothing)."""
    for batch in batches:
        known = [i is not None and k is not None for i, k in zip(batch.column("vec_id").to_pylist(), batch.column("label").to_pylist())]
        made = [v if k else None for v, k in zip(_bytes_of(batch.column("embedding")), known)]
        width = batch.column("embedding").type.value_type.bit_width // 8 if pa.types.is_floating(batch.column("embedding").type.value_type) else 8
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), pa.array([0 if v is None else len(v) // (4 if width == 4 else 8) for v in made], pa.int32()), pa.array(made, pa.binary()),
             pa.array([None if v is None else hashlib.blake2b(v, digest_size=16).digest() for v in made], pa.binary())],
            names=["vec_id", "label", "dims", "raw", "hash"],
        )


def _units(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each number of dimensions: the rows that have it, and their unit vectors."""
    dims = batch.column("dims").to_numpy()
    raws = batch.column("raw").to_pylist()
    for d in np.unique(dims):
        at = np.nonzero(dims == d)[0]
        yield int(d), at, np.stack([unit_of(raws[i], int(d)) for i in at])


def _moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and number of dimensions: sums and products of the unit vectors, a row of the matrix each."""
    total: dict[int, list] = {}
    for batch in batches:
        for d, _, x in _units(batch):
            now = total.setdefault(d, [np.zeros(d), np.zeros((d, d)), 0])
            now[0] += x.sum(0)
            now[1] += x.T @ x
            now[2] += len(x)
    for d, (sums, products, n) in total.items():
        rows = [*products, np.append(sums, n)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([d] * len(rows), pa.int32()), pa.array(range(len(rows)), pa.int32()), pa.array([r.tobytes() for r in rows], pa.binary())], names=["dims", "part", "sums"]
        )


def _summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for d, part, raw in zip(*(batch.column(c).to_pylist() for c in ("dims", "part", "sums"))):
            total[d, part] = total.get((d, part), 0.0) + np.frombuffer(raw)
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in total], pa.int32()), pa.array([k[1] for k in total], pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
        names=["dims", "part", "sums"],
    )


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each number of dimensions met: an orthonormal basis, largest variance first, from all of `vectors` (dims, raw).

    Moments are added up on the executors, row by row of the matrix; d + 1 rows of d numbers reach the driver.
    """
    schema = "dims int, part int, sums binary"
    parts: dict[int, dict[int, np.ndarray]] = {}
    for r in vectors.select("dims", "raw").mapInArrow(_moments, schema).repartition("dims", "part").mapInArrow(_summed, schema).toLocalIterator():
        parts.setdefault(r["dims"], {})[r["part"]] = np.frombuffer(r["sums"])
    axes = {}
    for d, rows in parts.items():
        n, mean = rows[d][d], rows[d][:d] / rows[d][d]
        _, found = np.linalg.eigh(np.stack([rows[k] for k in range(d)]) / n - np.outer(mean, mean))
        axes[d] = np.ascontiguousarray(found[:, ::-1])
    return axes


PLACED = ("class_id", "block", "copies", "dims", "raw", "hash")


def _leads(axes: dict[int, np.ndarray]):
    """Places on the first two principal axes (0 for the second where there is one dimension)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead, second = np.zeros(len(batch)), np.zeros(len(batch))
            for d, at, x in _units(batch):
                turned = x @ axes[d][:, :2]
                lead[at] = turned[:, 0]
                if d > 1:
                    second[at] = turned[:, 1]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in PLACED), pa.array(lead), pa.array(second)], names=[*PLACED, "lead", "second"])

    return run, "class_id long, block string, copies long, dims int, raw binary, hash binary, lead double, second double"


def close_pairs(unit: tuple[np.ndarray, np.ndarray], turned: tuple[np.ndarray, np.ndarray], threshold: float, step: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) of two tiles whose cosine is `threshold` or more.

    `turned` holds the vectors on the principal axes. Products are added up `step` dimensions at a time; a pair is
    given up once its sum and the product of the norms of what remains (Cauchy-Schwarz) stay below the threshold.
    What survives is decided by the plain double-precision dot product of the unit vectors.
    """
    a, b = turned
    d = a.shape[1]
    rest_a, rest_b = (np.sqrt(np.maximum(np.cumsum(x[:, ::-1] ** 2, axis=1)[:, ::-1], 0)) for x in (a, b))
    partial = a[:, :step] @ b[:, :step].T
    at = min(step, d)
    bound = partial + np.outer(rest_a[:, at], rest_b[:, at]) if at < d else partial
    i, j = np.nonzero(bound >= threshold - SLACK)
    sums = partial[i, j]
    while at < d and len(i):
        to = min(at + step, d)
        sums = sums + np.einsum("nk,nk->n", a[i, at:to], b[j, at:to])
        at = to
        kept = sums + (rest_a[i, at] * rest_b[j, at] if at < d else 0) >= threshold - SLACK
        i, j, sums = i[kept], j[kept], sums[kept]
    exact = np.einsum("nk,nk->n", unit[0][i], unit[1][j])
    kept = exact >= threshold
    return i[kept], j[kept]


def _cell(threshold: float, axes: dict[int, np.ndarray], part_rows: int = 512):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        _, first, second = key
        ids, copies, d = frame["class_id"].to_numpy(), frame["copies"].to_numpy(), int(frame["dims"].iloc[0])
        unit = np.stack([unit_of(x, d) for x in frame["raw"]])
        turned = unit @ axes[d]
        tile = frame["tile"].to_numpy()
        left, right = np.nonzero(tile == first)[0], np.nonzero(tile == second)[0]
        degree = np.zeros(len(frame), dtype=np.int64)
        root = np.arange(len(frame))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        u, v = [], []
        for s in range(0, len(left), part_rows):
            for t in range(0, len(right), part_rows):
                l, r = left[s : s + part_rows], right[t : t + part_rows]
                i, j = close_pairs((unit[l], unit[r]), (turned[l], turned[r]), threshold)
                i, j = l[i], r[j]
                once = i < j if first == second else i != j
                i, j = i[once], j[once]
                np.add.at(degree, i, copies[j])
                np.add.at(degree, j, copies[i])
                while len(i):  # joins what is not joined yet; linked pairs of one component are passed over together
                    x, y = find(int(i[0])), find(int(j[0]))
                    if x != y:
                        root[max(x, y)] = min(x, y)
                        u.append(ids[i[0]])
                        v.append(ids[j[0]])
                    roots = np.array([find(k) for k in range(len(root))]) if len(i) > len(root) else None
                    apart = roots[i] != roots[j] if roots is not None else np.array([find(int(p)) != find(int(q)) for p, q in zip(i, j)])
                    i, j = i[apart], j[apart]
        hit = degree > 0
        return pd.DataFrame({
            "u": np.concatenate([ids[hit], np.array(u, dtype=np.int64)]).astype(np.int64),
            "v": np.concatenate([np.full(hit.sum(), -1), np.array(v, dtype=np.int64)]).astype(np.int64),
            "degree": np.concatenate([degree[hit], np.zeros(len(u), dtype=np.int64)]).astype(np.int64),
        })

    return run


FINE = 1 << 16


def _fine(value: Column) -> Column:
    """One of 65536 even steps of [-1, 1]; any place within a step is within 2 / 65536 of another."""
    return F.greatest(F.lit(0), F.least(F.lit(FINE - 1), F.floor((value + 1) / 2 * FINE))).cast("int")


def _cuts(rows: DataFrame, keys: list[str], step: str, wanted: Column, out: str) -> DataFrame:
    """(keys, step, `out`): steps of a block in order, cut into about `wanted` runs of equal numbers of rows.

    `wanted` is an expression over `n`, the rows of the block. A block has 65536 steps at most, whatever its rows.
    """
    counted = rows.groupBy(*keys, step).agg(F.count("*").alias("_rows"))
    whole = W.partitionBy(*keys)
    before = whole.orderBy(step).rowsBetween(W.unboundedPreceding, -1)
    summed = counted.withColumn("n", F.sum("_rows").over(whole)).withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    return summed.select(*keys, step, F.floor(F.col("_before") * wanted / F.col("n")).cast("int").alias(out))


def tiled(placed: DataFrame, threshold: float, tile_rows: int) -> DataFrame:
    """`placed` (block, lead, second, class_id, ...) with `tile` and the tiles that each is to meet, `others`.

    A block is cut into strips along the first principal axis and the strips into tiles along the second, as many as
    its rows need; rows of one place beyond `tile_rows` are dealt over several tiles by a hash. Two tiles meet if the
    gaps between them on both axes leave a cosine of `threshold` possible (|u - v|^2 = 2 - 2 cos).
    """
    stepped = placed.withColumn("_one", _fine(F.col("lead"))).withColumn("_two", _fine(F.col("second")))
    strips = _cuts(stepped, ["block"], "_one", F.ceil(F.sqrt(F.ceil(F.col("n") / tile_rows))), "_strip")
    in_strip = stepped.join(strips, ["block", "_one"])
    columns = _cuts(in_strip, ["block", "_strip"], "_two", F.ceil(F.col("n") / tile_rows), "_column")
    crowd = in_strip.join(columns, ["block", "_strip", "_two"])
    sizes = crowd.groupBy("block", "_strip", "_column").agg(
        F.ceil(F.count("*") / (2 * tile_rows)).cast("int").alias("_parts"), F.min("lead").alias("a0"), F.max("lead").alias("a1"), F.min("second").alias("b0"), F.max("second").alias("b1")
    )
    number = sizes.withColumn("_tiles", F.transform(F.sequence(F.lit(0), F.col("_parts") - 1), lambda k: F.xxhash64("_strip", "_column", k)))
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6
    # strips are looked up by a grid of cells of the reach on both axes, so that distant tiles are never paired
    cell = lambda v: F.floor(v / reach).cast("int")
    spread = lambda lo, hi: F.sequence(cell(F.col(lo)), cell(F.col(hi)))
    boxes = number.select("block", "_strip", "_column", "_tiles", "a0", "a1", "b0", "b1")
    mine = boxes.withColumn("_ga", F.explode(spread("a0", "a1"))).withColumn("_gb", F.explode(spread("b0", "b1")))
    near = boxes.select("block", *(F.col(c).alias(f"o{c}") for c in ("a0", "a1", "b0", "b1", "_tiles")))
    near = near.withColumn("_ga", F.explode(F.sequence(cell(F.col("oa0")) - 1, cell(F.col("oa1")) + 1))).withColumn("_gb", F.explode(F.sequence(cell(F.col("ob0")) - 1, cell(F.col("ob1")) + 1)))
    gap = lambda x: F.greatest(F.lit(0.0), F.col(f"o{x}0") - F.col(f"{x}1"), F.col(f"{x}0") - F.col(f"o{x}1"))
    close = gap("a") * gap("a") + gap("b") * gap("b") <= reach * reach
    meets = mine.join(near, ["block", "_ga", "_gb"]).filter(close).select("block", "_strip", "_column", F.explode("o_tiles").alias("other")).groupBy("block", "_strip", "_column").agg(F.collect_set("other").alias("others"))
    part = F.pmod(F.xxhash64("class_id"), F.size("_tiles")) + 1
    return crowd.join(number.select("block", "_strip", "_column", "_tiles").join(meets, ["block", "_strip", "_column"]), ["block", "_strip", "_column"]).select(
        *placed.columns, F.element_at("_tiles", part.cast("int")).alias("tile"), "others"
    )


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, tile_rows: int = 2048, block: str = "label") -> DataFrame:
    """Links the vectors of `vectors` (vec_id, embedding, label) whose cosine is `threshold` or more, within a label.

    Returns per vector: vec_id, class_id (smallest vec_id of equal vector and label), n_links (other vectors linked
    directly), component_id (smallest vec_id reachable by links, itself included) and kept. Vectors that are null,
    empty, zero, of another length, or hold a null or non-finite component, and rows with a null label or vec_id, link with
    nothing. Equal vectors form a class, compared once and counted by their copies; ties of order go by vec_id. Other
    columns are ignored, whatever their names; an empty table gives no rows; rows that share a vec_id count as one vector
    each. Vectors of any length are taken; a task holds two tiles of them and, per number of dimensions d, d x d axes.

    Classes of a label are cut into tiles along the first two principal axes (`tiled`), two tiles a task. In a task leading
    dimensions come first and the rest is bounded by suffix norms (`close_pairs`).
    """
    kind = vectors.schema[block].dataType.simpleString()
    usable = staged(vectors.select("vec_id", F.col(block).alias("label"), "embedding").mapInArrow(_usable, f"vec_id long, label {kind}, dims int, raw binary, hash binary"), "vectors")
    good = usable.filter("raw is not null").withColumn("block", F.concat_ws("/", "dims", F.col("label").cast("string")))
    classes = good.groupBy("block", "hash").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("copies"), F.first("dims").alias("dims"), F.first("raw").alias("raw"))
    axes = principal_axes(good)
    lead, schema = _leads(axes)
    placed = staged(classes.select(*PLACED).mapInArrow(lead, schema), "placed")
    cells = tiled(placed, threshold, tile_rows).withColumn("other", F.explode("others")).select(
        "class_id", "copies", "dims", "raw", "block", "tile", F.least("tile", "other").alias("first"), F.greatest("tile", "other").alias("second")
    )
    found = staged(cells.groupBy("block", "first", "second").applyInPandas(_cell(threshold, axes), "u long, v long, degree long"), "links")
    merged = components(found.filter("v >= 0").select("u", "v"), "vector-links")
    degrees = found.filter("v < 0").groupBy(F.col("u").alias("class_id")).agg(F.sum("degree").alias("degree"))
    known = placed.select("block", "hash", "class_id", "copies").join(degrees, "class_id", "left").join(merged.withColumnRenamed("node", "class_id"), "class_id", "left")
    linked = good.select("vec_id", "block", "hash").join(known, ["block", "hash"]).select(
        "vec_id", "class_id", (F.coalesce("degree", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "class_id").alias("component_id")
    )
    alone = usable.filter("raw is null").select("vec_id", F.col("vec_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
