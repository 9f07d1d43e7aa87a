"""Lifecycle of postings over snapshots of their source."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

CLOSES_AT = 2


def age_missing(jobs: DataFrame, observed: DataFrame, source_id: str) -> DataFrame:
    """`jobs` after a full snapshot of `source_id` that holds the ids `observed` (job_id).

    An active posting of the source that is not observed misses one more run and closes at the second. An empty
    snapshot is an anomaly and changes nothing.
    """
    if observed.isEmpty():
        return jobs
    seen = observed.select("job_id").distinct().withColumn("_seen", F.lit(True))
    missing = (F.col("source_id") == source_id) & (F.col("status") == "active") & F.col("_seen").isNull()
    aged = F.col("missing_runs") + 1
    joined = jobs.join(seen, "job_id", "left")
    return joined.select(
        *(
            F.when(missing, aged).otherwise(F.col(c)).cast(jobs.schema[c].dataType).alias(c) if c == "missing_runs"
            else F.when(missing & (aged >= CLOSES_AT), F.lit("closed")).otherwise(F.col(c)).alias(c) if c == "status"
            else F.col(c)
            for c in jobs.columns
        )
    )


def aged(jobs: DataFrame, observed: DataFrame, source_id: str) -> DataFrame:
    """The rows of `jobs` that `age_missing` changes, after the change: active ones of the source that are not observed."""
    missing = jobs.filter((F.col("source_id") == source_id) & (F.col("status") == "active")).join(observed.select("job_id").distinct(), "job_id", "left_anti")
    runs = F.col("missing_runs") + 1
    changed = {"missing_runs": runs.cast(jobs.schema["missing_runs"].dataType), "status": F.when(runs >= CLOSES_AT, "closed").otherwise(F.col("status"))}
    return missing.select(*(changed.get(c, F.col(c)).alias(c) for c in jobs.columns))


def history(snapshots: DataFrame) -> DataFrame:
    """Status of each posting after all `snapshots` (source_id, run_day, job_id), one row an observation.

    Runs that hold nothing leave no row, so a posting has missed the runs after the one that saw it last, up to two.
    """
    runs = snapshots.select("source_id", "run_day").distinct().withColumn("run", F.row_number().over(W.partitionBy("source_id").orderBy("run_day")))
    last_run = runs.groupBy("source_id").agg(F.max("run").alias("runs"))
    seen = snapshots.groupBy("source_id", "job_id").agg(F.max("run_day").alias("run_day"), F.min("run_day").alias("first_day"))
    placed = seen.join(runs, ["source_id", "run_day"]).join(last_run, "source_id")
    missed = F.least(F.lit(CLOSES_AT), F.col("runs") - F.col("run"))
    return placed.select("source_id", "job_id", "first_day", F.col("run_day").alias("last_day"), missed.alias("missing_runs"), F.when(missed >= CLOSES_AT, "closed").otherwise("active").alias("status"))
