"""Upserts as joins: Parquet tables have no MERGE, so each gives the next snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F


def last_per_key(rows: DataFrame, key: str | list[str], *order) -> DataFrame:
    """The last row of each key by `order`."""
    keys = [key] if isinstance(key, str) else key
    by = W.partitionBy(*keys).orderBy(*(F.desc(o) for o in order))
    return rows.withColumn("_rank", F.row_number().over(by)).filter("_rank = 1").drop("_rank")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """`old` with every row of `new` in place of the row of its key. `new` has one row a key."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def insert_missing(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """`old` and the rows of `new` whose key it lacks."""
    return old.unionByName(new.dropDuplicates([key]).join(old.select(key), key, "left_anti"))


def upsert_columns(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """`old` with `columns` taken from `new` where the key is known, and the other rows of `new` added."""
    fresh = new.select(F.col(key).alias("_key"), F.lit(True).alias("_seen"), *(F.col(c).alias(f"_{c}") for c in columns))
    joined = old.join(fresh, old[key] == fresh["_key"], "left")
    kept = joined.select(*(F.when(F.col("_seen"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in old.columns))
    return kept.unionByName(new.join(old.select(key), key, "left_anti"))
