"""Lifecycle kept by a stream of snapshots: each micro-batch ages what it does not hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lifecycle import CLOSES_AT
from ..sinks.store import Store

LAST_BATCH = "stream_batch"


def apply_snapshots(store: Store, observations: DataFrame, batch_id: int | None = None) -> bool:
    """Applies observations (source_id, job_id, observed_at, and `complete` boolean or none) to the postings of `store`.

    A posting seen again is active with no missed run and keeps its first sight. The other active postings of a source miss
    one run if the batch holds a row of the source marked `complete` (the last of its snapshot), so half a snapshot ages
    nothing; without the column every batch is a whole snapshot. Sources that the batch does not name stay as they are. A
    batch that was committed before (`batch_id` not above the last) changes nothing. One join for all sources.
    """
    base = store.version()
    if batch_id is not None and batch_id <= store.notes().get(LAST_BATCH, -1):
        return False
    jobs = store.read("jobs")
    whole = F.max("complete") if "complete" in observations.columns else F.lit(True)
    sources = observations.groupBy(F.col("source_id").alias("_source")).agg(whole.alias("_whole"))
    seen = observations.groupBy("job_id").agg(F.max("observed_at").alias("_at"))
    again = F.col("_at").isNotNull()
    missed = ~again & F.coalesce("_whole", F.lit(False)) & (F.col("status") == "active")
    runs = F.when(again, 0).otherwise(F.when(missed, F.col("missing_runs") + 1).otherwise(F.col("missing_runs")))
    status = F.when(again, "active").otherwise(F.when(missed & (F.col("missing_runs") + 1 >= CLOSES_AT), "closed").otherwise(F.col("status")))
    changed = {"last_seen_at": F.when(again, F.greatest("last_seen_at", "_at")).otherwise(F.col("last_seen_at")), "status": status, "missing_runs": runs}
    joined = jobs.join(seen, "job_id", "left").join(sources, F.col("source_id") == F.col("_source"), "left")
    merged = joined.select(*(changed.get(c, F.col(c)).alias(c) for c in jobs.columns))
    store.commit({"jobs": merged}, {} if batch_id is None else {LAST_BATCH: batch_id}, base)
    return True


def follow(store: Store, observations: DataFrame, checkpoint: str):
    """A streaming query that applies each micro-batch of `observations` (a streaming frame) once, replays included."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            apply_snapshots(store, held, batch_id)
        finally:
            held.unpersist()

    return observations.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).start()


def windowed_counts(events: DataFrame, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Observations a source and window, late rows dropped after `late`; works on streams and tables."""
    return events.withWatermark("observed_at", late).groupBy(F.window("observed_at", width), "source_id").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "source_id", "n")
