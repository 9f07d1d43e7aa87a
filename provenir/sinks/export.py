"""Public datasets: views, writers, metadata and manifest."""

from __future__ import annotations

import json
import shutil
from dataclasses import asdict
from datetime import UTC, datetime
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quality import public_job
from ..sources.catalog import Source

FORMATS = ("csv", "jsonl", "parquet", "duckdb")


VIEWS = ("companies", "jobs", "evidence", "runs")


def public_view(tables: dict[str, DataFrame], name: str) -> DataFrame:
    """One public dataset, in order; nulls last wherever rows are sorted. Only the tables that it is made of are read."""
    companies = lambda: tables["companies"].filter("active")
    jobs = lambda: tables["jobs"].filter(public_job())
    if name == "companies":
        return companies().orderBy(F.asc_nulls_last("canonical_name"), "company_id")
    if name == "jobs":
        return jobs().drop("public_description").orderBy(F.desc_nulls_last("last_seen_at"), "job_id")
    if name == "evidence":
        published = companies().select(F.col("company_id").alias("record_id")).unionByName(jobs().select(F.col("job_id").alias("record_id")))
        return tables["evidence"].join(published, "record_id", "left_semi").select(*tables["evidence"].columns).orderBy("record_type", "record_id", "evidence_id")
    if name == "runs":
        return tables["ingestion_runs"].drop("metrics_json").orderBy(F.desc_nulls_last("started_at"), "run_id")
    raise ValueError(f"no view {name}")


def public_views(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The four public datasets."""
    return {name: public_view(tables, name) for name in VIEWS}


def _flat(rows: DataFrame) -> DataFrame:
    """Arrays as JSON text and instants as ISO text, for formats without them."""
    made = []
    for f in rows.schema:
        kind = f.dataType.typeName()
        made.append((F.to_json(f.name) if kind == "array" else F.date_format(f.name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX") if kind == "timestamp" else F.col(f.name)).alias(f.name))
    return rows.select(*made)


def write(rows: DataFrame, path: str, kind: str) -> None:
    """One dataset as a directory of part files, in the order of `rows`."""
    if kind == "csv":
        _flat(rows).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)
    elif kind == "jsonl":
        _flat(rows).write.mode("overwrite").option("ignoreNullFields", False).json(path)
    elif kind == "parquet":
        rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
    else:
        raise ValueError(f"no format {kind}")


def write_database(views: dict[str, DataFrame], path: Path) -> None:
    """A DuckDB file with a table a dataset. The executors write Parquet parts beside it, which DuckDB then reads in their order;
    no row passes through Python."""
    import duckdb

    path.unlink(missing_ok=True)
    parts = path.with_name(f"{path.name}.parts")
    with duckdb.connect(str(path)) as target:
        target.execute("SET TimeZone='UTC'")
        for name, rows in views.items():
            # instants as whole microseconds: the same in every version of Parquet
            told = rows.select(*(F.unix_micros(f.name).alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name) for f in rows.schema))
            write(told, str(parts / name), "parquet")
            columns = ", ".join(f'make_timestamptz("{f.name}") AS "{f.name}"' if f.dataType.typeName() == "timestamp" else f'"{f.name}"' for f in rows.schema)
            files = sorted(str(p) for p in (parts / name).glob("part-*"))
            target.execute(f"CREATE TABLE {name} AS SELECT {columns} FROM read_parquet({files})")
    shutil.rmtree(parts)


def manifest(spark, folder: str) -> DataFrame:
    """path (relative to the folder), bytes and sha256 of every file below `folder` but its manifest.json, read on the executors."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    inside = F.substring(F.col("path"), len(whole) + 2, 1 << 20)
    return files.filter(inside != "manifest.json").select(inside.alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")).orderBy("path")


def counted(tables: dict[str, DataFrame]) -> dict[str, int]:
    """Companies, public postings, pending reviews and failed runs, in one job."""
    wanted = {
        "companies": tables["companies"].filter("active"), "active_jobs": tables["jobs"].filter(public_job()),
        "pending_review": tables["review_queue"].filter("status = 'pending'"), "failed_runs": tables["ingestion_runs"].filter("status = 'failed'"),
    }
    parts = [rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, rows in wanted.items()]
    return {r["name"]: r["n"] for r in reduce(DataFrame.unionByName, parts).collect()}


def export(tables: dict[str, DataFrame], sources: dict[str, Source], folder: str | Path, kind: str = "csv") -> list[str]:
    """Every public dataset in one format, with sources.json, ATTRIBUTION.md, COVERAGE.md, DATA_DICTIONARY.md and manifest.json."""
    if kind not in FORMATS:
        raise ValueError(f"no format {kind}")
    out = Path(folder)
    out.mkdir(parents=True, exist_ok=True)
    views = public_views(tables)
    if kind == "duckdb":
        write_database(views, out / "public.duckdb")
    else:
        for name, rows in views.items():
            write(rows, str(out / f"{name}.{kind}"), kind)
    totals = counted(tables)
    counts = {"Verified/relevant companies": totals["companies"], "Active publishable jobs": totals["active_jobs"], "Pending review items": totals["pending_review"]}
    now = datetime.now(UTC).isoformat()
    (out / "sources.json").write_text(json.dumps([asdict(s) for s in sources.values()], indent=2, ensure_ascii=False), encoding="utf-8")
    credits = "".join(f"- **{s.name}:** {s.attribution} ({s.terms_url or s.base_url or 'manual source'})\n" for s in sources.values())
    (out / "ATTRIBUTION.md").write_text(f"# Source attribution\n\n{credits}", encoding="utf-8")
    told = "".join(f"- {k}: {v}\n" for k, v in counts.items())
    (out / "COVERAGE.md").write_text(f"# Coverage report\n\nGenerated: {now}\n\n{told}\nCounts describe the public sources observed, not a whole labour market.\n", encoding="utf-8")
    columns = "".join(f"\n## {n}\n\n" + "".join(f"- `{f.name}`: {f.dataType.simpleString()}\n" for f in rows.schema) for n, rows in views.items())
    (out / "DATA_DICTIONARY.md").write_text(f"# Data dictionary\n{columns}", encoding="utf-8")
    spark = views["jobs"].sparkSession
    listed = [r.asDict() for r in manifest(spark, str(out)).toLocalIterator()]
    (out / "manifest.json").write_text(json.dumps({"schema_version": "1.0.0", "generated_at": now, "license": "ODC-BY-1.0 with source-specific restrictions", "files": listed}, indent=2), encoding="utf-8")
    return sorted(p.name for p in out.iterdir())


def pending_reviews(tables: dict[str, DataFrame]) -> DataFrame:
    """The pending review items, oldest first."""
    return tables["review_queue"].filter("status = 'pending'").orderBy("created_at", "review_id")


def export_review(tables: dict[str, DataFrame], path: str) -> int:
    """The pending review items as JSON lines, oldest first; how many there are."""
    pending = pending_reviews(tables)
    write(pending, path, "jsonl")
    return pending.count()


def restored(spark, folder: str, name: str, schema: str) -> DataFrame:
    """A table from its CSV export: columns by name, cast where they can be, null where they are missing."""
    raw = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).csv(f"{folder}/{name}.csv")
    made = []
    for part in schema.split(", "):
        column, kind = part.split(" ", 1)
        text = F.col(column) if column in raw.columns else F.lit(None).cast("string")
        made.append((F.from_json(text, kind) if kind.startswith("array") else text.try_cast(kind)).alias(column))
    return raw.select(*made)
