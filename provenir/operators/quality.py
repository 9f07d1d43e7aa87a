"""Quality rules over the tables: one issue a row that offends, and the metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window as W
from pyspark.sql import functions as F

from ..schemas import KEYS
from ..staging import staged

RELEASE = {"company": 500, "job": 2000}
LEAST_COMPLETE, DROP = 0.95, 0.5
RESTRICTED = ("restricted", "unknown")


def _issues(rows: DataFrame, code: str | Column, message: str | Column, record_type: str | None, record_id: Column | None) -> DataFrame:
    text = F.lit(message) if isinstance(message, str) else message
    return rows.select(F.lit("error").alias("severity"), (F.lit(code) if isinstance(code, str) else code).alias("code"), text.alias("message"), F.lit(record_type).cast("string").alias("record_type"), (F.lit(None) if record_id is None else record_id).cast("string").alias("record_id"))


def public_job() -> Column:
    return (F.col("status") == "active") & (F.col("eligibility") != "ineligible")


def missing_fields(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Keys of rows in which a required field is null."""
    return rows.filter(reduce(lambda a, b: a | b, (F.col(f).isNull() for f in fields))).select(key)


def without_evidence(rows: DataFrame, key: str, evidence: DataFrame, record_type) -> DataFrame:
    """Keys of rows that no evidence names."""
    known = evidence.filter((F.col("record_type") == record_type) & F.col("evidence_id").isNotNull()).select(F.col("record_id").alias(key))
    return rows.select(key).join(known, key, "left_anti")


def duplicate_fingerprints(jobs: DataFrame, fingerprint: str = "fingerprint") -> DataFrame:
    return jobs.groupBy(fingerprint).agg(F.count("*").alias("n")).filter("n > 1")


def from_restricted(rows: DataFrame, key: str, source_column: str, sources: DataFrame) -> DataFrame:
    """Keys of rows of a source whose terms are restricted or unreviewed."""
    bad = sources.filter(F.col("redistribution").isin(*RESTRICTED)).select(F.col("id").alias(source_column))
    return rows.join(bad, source_column, "left_semi").select(key)


def latest_two(runs: DataFrame) -> DataFrame:
    """source_id, newest, previous and ratio of the job counts of the last two completed runs of each source."""
    by = W.partitionBy("source_id").orderBy(F.desc_nulls_last("finished_at"), F.desc("run_id"))
    ranked = runs.filter("status = 'completed'").withColumn("_rank", F.row_number().over(by)).filter("_rank <= 2")
    sides = ranked.groupBy("source_id").agg(F.max(F.when(F.col("_rank") == 1, F.col("job_count"))).alias("newest"), F.max(F.when(F.col("_rank") == 2, F.col("job_count"))).alias("previous"))
    return sides.filter("previous <> 0").withColumn("ratio", F.col("newest") / F.col("previous"))


def completeness(rows: DataFrame, fields: list[str]) -> DataFrame:
    """One row: total, complete and ratio (1 for no rows) of rows that have every field."""
    whole = reduce(lambda a, b: a & b, (F.col(f).isNotNull() for f in fields))
    return rows.agg(F.count("*").alias("total"), F.count_if(whole).alias("complete")).withColumn("ratio", F.coalesce(F.try_divide(F.col("complete"), F.col("total")), F.lit(1.0)))


COMPANY_FIELDS = ["canonical_name", "primary_source_id", "primary_source_url", "confidence"]
JOB_FIELDS = ["title", "company_id", "role_family", "source_url", "eligibility", "last_seen_at"]


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    """Keys that more than one row has, or none at all (null)."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).filter(F.col(key).isNull() | (F.col("n") > 1)).select(key)


def broken_rules(rows: DataFrame, key: str, record_type: str, rules: dict[str, tuple[Column, str]], evidence: DataFrame, sources: DataFrame, source_column: str) -> DataFrame:
    """An issue for each rule that a row breaks, in one pass over `rows`.

    `rules`: by code, whether a row breaks the rule, and what to say; they may use `_known` (evidence names the row) and
    `_closed` (the terms of its source do not allow publication).
    """
    known = evidence.filter((F.col("record_type") == record_type) & F.col("evidence_id").isNotNull()).select(F.col("record_id").alias(key), F.lit(True).alias("_named")).distinct()
    closed = sources.filter(F.col("redistribution").isin(*RESTRICTED)).select(F.col("id").alias(source_column), F.lit(True).alias("_bad")).distinct()
    told = rows.join(known, key, "left").join(closed, source_column, "left").withColumns({"_known": F.col("_named").isNotNull(), "_closed": F.col("_bad").isNotNull()})
    broken = F.array_compact(F.array(*(F.when(holds, F.struct(F.lit(code).alias("code"), F.lit(message).alias("message"))) for code, (holds, message) in rules.items())))
    return told.select(F.col(key).cast("string").alias("record_id"), F.explode(broken).alias("b")).select(
        F.lit("error").alias("severity"), "b.code", "b.message", F.lit(record_type).alias("record_type"), "record_id"
    )


def _missing(fields: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(f).isNull() for f in fields))


def validate(tables: dict[str, DataFrame], sources: DataFrame, catalog_errors: list[str] = (), release: bool = False) -> tuple[DataFrame, dict[str, float]]:
    """(issues, metrics) of the tables. The report is good if there is no issue.

    One job a table: rules are told row by row while the metrics are observed in the same pass, and the issues are
    staged, so that neither reading them nor counting them runs a rule again. Repeated keys and fingerprints are one grouping each.
    """
    companies, jobs, evidence, runs = (tables[n] for n in ("companies", "jobs", "evidence", "ingestion_runs"))
    spark = companies.sparkSession
    live, public = F.col("status") == "active", public_job()
    seen = {"company": Observation(), "job": Observation()}

    def watched(rows: DataFrame, kind: str, counted: Column, fields: list[str]) -> DataFrame:
        return rows.observe(seen[kind], F.coalesce(F.count_if(counted), F.lit(0)).alias("total"), F.coalesce(F.count_if(counted & ~_missing(fields)), F.lit(0)).alias("complete"))

    active = F.coalesce(F.col("active"), F.lit(False))
    of_companies = {
        "company_required_fields": (_missing(COMPANY_FIELDS[:3]), "A field that every public company needs is empty."),
        "company_provenance": (active & ~F.col("_known"), "Nothing in the evidence names this company."),
        "restricted_company_source": (F.col("_closed"), "The company's source does not allow publication."),
    }
    of_jobs = {
        "job_required_fields": (live & _missing(["title", "company_id", "source_url", "eligibility_evidence"]), "A field that every active posting needs is empty."),
        "job_provenance": (live & ~F.col("_known"), "Nothing in the evidence names this posting."),
        "ineligible_active": (live & (F.col("eligibility") == "ineligible"), "The posting rules applicants out but is active."),
        "restricted_job_source": (F.col("_closed"), "The posting's source does not allow publication."),
    }
    parts = [
        staged(broken_rules(watched(companies, "company", active, COMPANY_FIELDS), "company_id", "company", of_companies, evidence, sources, "primary_source_id"), "company-issues"),
        staged(broken_rules(watched(jobs, "job", public, JOB_FIELDS), "job_id", "job", of_jobs, evidence, sources, "source_id"), "job-issues"),
    ]
    duplicates = duplicate_fingerprints(jobs.filter(live)).count()
    counts = {kind: seen[kind].get for kind in seen}
    ratio = {kind: c["complete"] / c["total"] if c["total"] else 1.0 for kind, c in counts.items()}
    metrics = {
        "active_companies": counts["company"]["total"], "active_jobs": counts["job"]["total"], "duplicate_job_fingerprints": duplicates,
        "company_required_field_completeness": ratio["company"], "job_required_field_completeness": ratio["job"],
    }
    said: list[tuple[str, str]] = [("source_catalog", e) for e in catalog_errors]
    if duplicates:
        said.append(("duplicate_jobs", f"{duplicates} fingerprints stand on more than one active posting."))
    said += [(f"{kind}_completeness", f"Only {ratio[kind]:.1%} of the rows have every required field; at least 95% must.") for kind in counts if counts[kind]["total"] and ratio[kind] < LEAST_COMPLETE]
    if release and metrics["active_companies"] < RELEASE["company"]:
        said.append(("release_company_count", f"{metrics['active_companies']} active companies; a release takes {RELEASE['company']}."))
    if release and metrics["active_jobs"] < RELEASE["job"]:
        said.append(("release_job_count", f"{metrics['active_jobs']} active postings; a release takes {RELEASE['job']}."))
    parts.append(_issues(spark.createDataFrame(said, "code string, message string"), F.col("code"), F.col("message"), None, None))
    drops = latest_two(runs.join(sources.select(F.col("id").alias("source_id")), "source_id", "left_semi")).filter(F.col("ratio") < DROP)
    parts.append(_issues(drops, "unexpected_source_drop", F.concat_ws("", "source_id", F.lit(": "), F.col("newest").cast("string"), F.lit(" postings after "), F.col("previous").cast("string"), F.lit(" in the run before.")), None, None))
    for name, key in KEYS.items():
        if name in tables:
            parts.append(_issues(duplicate_keys(tables[name], key), "duplicate_key", f"More than one row of {name} has this {key}, or it is null.", name, F.col(key)))
    return reduce(DataFrame.unionByName, parts), metrics
