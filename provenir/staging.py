"""Intermediate tables in the shared folder: computed once, kept when executors are lost."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
_PATHS: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: spark.checkpoint.dir. Where it is unset, one of our own, if all runs on this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="provenir-")
    return _OWN[app]


def staged(df: DataFrame, label: str, **options: str) -> DataFrame:
    """`df` written as Parquet in the shared folder and read back. The schema is that of `df`, so no file is opened for it."""
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    path = f"{shared_dir(spark)}/provenir-{app}/{label}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    _PATHS.setdefault(app, []).append(path)
    made = spark.read.schema(df.schema).parquet(path)
    made.staged_at = path
    return made


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def unstage(df: DataFrame) -> None:
    """Removes what `staged` wrote for this frame; to be called once nothing will read it again."""
    spark, path = df.sparkSession, df.staged_at
    _delete(spark, path)
    _PATHS[spark.sparkContext.applicationId].remove(path)


def release(spark: SparkSession) -> int:
    """Removes every staged table of this application; how many. Call it when no result that reads them is needed any more."""
    gone = _PATHS.pop(spark.sparkContext.applicationId, [])
    for path in gone:
        _delete(spark, path)
    return len(gone)
