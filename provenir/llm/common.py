"""Helpers the training-data operators share: staged tables, skew-safe ranks and components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from functools import reduce, wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from ..staging import staged, unstage

#: ASCII white space as the word contracts name it.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def tidy(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run` for mapInArrow, giving memory back to the system at the end of a task: workers are used again by later stages."""

    @wraps(run)
    def tidied(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):  # not glibc
                pass

    return tidied


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(columns or ("*",)))


def learnable(doc_id: Column) -> Column:
    """The rows that models may learn from: crc32(doc_id as text) mod 4 is not 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2, F.lit(False))


def words(text: Column) -> Column:
    """The words of a text, in order; an empty array for none. Split at white space, so linear in the text."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def salts_for(rows: int, each: int = 50_000, least: int = 64) -> int:
    return max(least, -(-rows // each))


def salted_rank(df: DataFrame, keys: list[str], order: list[str], salts: int, out: str) -> DataFrame:
    """`out`: 0-based rank of each row within its keys, without gathering a key in one task.

    Rows of a key are dealt over `salts` buckets by a hash of `order`; ranks within a bucket are shifted
    by the rows of the buckets before it. Keys must not be null. Equal rows get different ranks.
    """
    dealt = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    local = dealt.withColumn("_local", F.row_number().over(W.partitionBy(*keys, "_salt").orderBy(*order)) - 1)
    before = W.partitionBy(*keys).orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)
    shift = dealt.groupBy(*keys, "_salt").count().select(*keys, "_salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_shift"))
    return local.join(shift, [*keys, "_salt"]).withColumn(out, F.col("_shift") + F.col("_local")).drop("_salt", "_local", "_shift")


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of `edges` (u, v long): rows (node, component), component the smallest node reached.

    Alternates large-star and small-star contractions; every round is staged in the shared folder, hubs are
    reduced by partial aggregates and joined back (a join that adaptive execution can split), and nothing but
    two numbers a round reaches the driver; a round's table goes once the next is whole. Null and looped edges are left
    out, repeated ones count once. Nodes without an edge are not returned.
    """
    now = staged(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label)
    seen = None
    while True:
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
        last, now = now, staged(_stars(now), label)
        unstage(last)
    roots = now.groupBy("u").agg(F.min("v").alias("v"))
    return roots.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
    root = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(root, "u").select("v", "m").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(root.select("u", F.col("m").alias("v"))).distinct()


def fold(columns: list[Column], start: Column) -> Column:
    return reduce(lambda a, b: a + b, columns, start)
