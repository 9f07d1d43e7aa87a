"""Session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Results depend on the first; the others let Spark adapt partitions to what a stage really holds.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "provenir", **settings: str) -> SparkSession:
    """A session with the engine's settings; the master and memory come from the caller's environment."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
