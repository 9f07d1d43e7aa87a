"""Postings: from candidates to rows, one row a posting over all its sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from ..functions import ids, rules, urls
from ..functions.text import clean_text, first_truthy, normalize_text, truthy
from .upsert import last_per_key


def classified(candidates: DataFrame) -> DataFrame:
    """Candidates (JOB_CANDIDATE and pos) with role, eligibility and the texts they were read from.

    Built-in columns and Arrow functions are kept in two steps, so that the text is normalised once a row.
    """
    texts = candidates.select(
        "*",
        normalize_text(F.concat_ws(" ", "title", F.coalesce("description", F.lit("")))).alias("_text"),
        normalize_text(rules.evidence_text(F.col("candidate_location"), F.col("location_text"), F.col("description"))).alias("_evidence"),
    )
    verdict = rules.eligibility(F.col("_evidence"), F.col("workplace_type"), F.col("candidate_location"), F.col("location_text"))
    return texts.withColumn("role_family", rules.classify_role(F.col("_text"))).withColumn("_eligibility", verdict)


def employers(jobs: DataFrame) -> DataFrame:
    """Company candidates that classified candidates imply."""
    status = F.col("_eligibility.status")
    text = lambda: F.lit(None).cast("string")
    return jobs.select(
        "pos", "source_id", "source_url", text().alias("external_id"), F.col("company_name").alias("name"), text().alias("legal_name"), F.array().cast("array<string>").alias("aliases"),
        F.col("company_website").alias("website"), text().alias("careers_url"), F.array(F.lit("technology_employer")).alias("sectors"),
        F.when(status.isin("eligible", "likely"), "hires").otherwise("unknown").alias("nepal_relationship"), *(text().alias(c) for c in ("country", "locality", "address", "official_email", "official_phone", "profile")),
        F.lit(0.75).alias("confidence"), "observed_at",
    )


def normalised(jobs: DataFrame) -> DataFrame:
    """Posting rows (with pos) of classified candidates that have a company_id; ids are those of a first sight."""
    title = F.coalesce(clean_text(F.col("title"), 300), F.col("title"))
    base = jobs.withColumn("_title", title).withColumn("_url", F.coalesce(urls.canonical_url(F.col("source_url")), F.col("source_url"))).withColumn("_apply", urls.canonical_url(F.col("apply_url")))
    supplied = F.filter(F.transform(F.split(normalize_text(F.concat_ws("\x1f", "skills")), "\x1f"), F.trim), lambda s: s != "")
    texts = base.select("*", normalize_text("_title").alias("_title_key"), normalize_text("location_text").alias("_place_key"), normalize_text("description").alias("_body"),
                        normalize_text("employment_type").alias("_employment"), normalize_text(first_truthy(F.col("external_id"), F.col("_apply"), F.col("_url"))).alias("_material"),
                        normalize_text("source_id").alias("_source"), normalize_text("company_id").alias("_company"), supplied.alias("_supplied"))
    seniority = rules.classify_seniority(F.col("_text"))
    years, pay, e = rules.extract_experience(F.col("_body")), rules.parse_salary(F.col("salary_text")), F.col("_eligibility")
    made = texts.withColumn("_seniority", seniority).withColumn("_years", years).withColumn("_pay", pay)
    return made.select(
        "pos", ids.stable_id("job", F.col("_source"), F.col("_material")).alias("job_id"), "company_id", F.col("_title").alias("title"), "role_family", F.col("_seniority").alias("seniority"),
        rules.employment_type(F.col("_employment")).alias("employment_type"), "workplace_type", clean_text(F.col("location_text"), 300).alias("location_text"),
        clean_text(F.col("candidate_location"), 300).alias("candidate_location"), e["status"].alias("eligibility"), e["confidence"].alias("eligibility_confidence"),
        F.coalesce(clean_text(e["evidence"], 500), F.lit(rules.NO_EVIDENCE)).alias("eligibility_evidence"), e["explanation"].alias("eligibility_explanation"),
        F.lit(rules.RULE_VERSION).alias("eligibility_rule_version"), clean_text(F.col("salary_text"), 300).alias("salary_text"), F.col("_pay.min").alias("salary_min"),
        F.col("_pay.max").alias("salary_max"), F.col("_pay.currency").alias("salary_currency"), F.col("_pay.period").alias("salary_period"),
        rules.extract_skills(F.col("_text"), F.col("_supplied")).alias("skills"), F.col("_years.min").alias("min_years_experience"), F.col("_years.max").alias("max_years_experience"),
        rules.is_early_career(F.col("_seniority"), F.col("_years.min")).alias("early_career_fit"), "source_id", F.col("_url").alias("source_url"), F.col("_apply").alias("apply_url"),
        F.when(F.col("description_public"), clean_text(F.col("description"), 2000)).alias("public_description"), "posted_at", "expires_at", F.col("observed_at").alias("first_seen_at"),
        F.col("observed_at").alias("last_seen_at"), F.when(F.coalesce("explicitly_closed", F.lit(False)), "closed").otherwise("active").alias("status"), F.lit(0).alias("missing_runs"),
        ids.stable_id("job-fingerprint", F.col("_company"), F.col("_title_key"), F.col("_place_key")).alias("fingerprint"), "attribution",
    )


def deduplicate(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """Rows to upsert by job_id: `fresh` (one source, with pos) against `existing`, in closed form.

    A fingerprint that is known keeps id and first sight of its oldest row, and that row's source if its priority is
    higher. Within the batch the first of a fingerprint gives id and first sight, the last everything else; of rows
    that end with one job_id the last stays. One shuffle by fingerprint and one by id.
    """
    oldest = W.partitionBy("fingerprint").orderBy("first_seen_at", "job_id")
    known = existing.withColumn("_rank", F.row_number().over(oldest)).filter("_rank = 1").select(
        "fingerprint", F.col("job_id").alias("_id"), F.col("first_seen_at").alias("_seen"), F.col("source_id").alias("_source"), F.col("source_url").alias("_url"), F.col("attribution").alias("_by")
    )
    group = W.partitionBy("fingerprint")
    first = lambda c: F.min_by(c, "pos").over(group)
    batch = fresh.withColumn("_first_id", first("job_id")).withColumn("_first_seen", first("first_seen_at"))
    joined = last_per_key(batch, "fingerprint", "pos").join(known, "fingerprint", "left")
    held = F.col("_id").isNotNull() & (rules.source_priority(F.col("_source")) > rules.source_priority(F.col("source_id")))
    chosen = joined.withColumns({
        "job_id": F.coalesce("_id", "_first_id"), "first_seen_at": F.coalesce("_seen", "_first_seen"), "source_url": F.when(held, F.col("_url")).otherwise(F.col("source_url")),
        "attribution": F.when(held, truthy(F.col("_by"))).otherwise(F.col("attribution")), "source_id": F.when(held, F.col("_source")).otherwise(F.col("source_id")),
    })
    return last_per_key(chosen, "job_id", "pos").select(*existing.columns)


def evidence(rows: DataFrame, record_type: str, record_id: str, snippet, confidence, attribution, hashes: DataFrame | None) -> DataFrame:
    """Evidence rows of `rows` (source_id, source_url, observed_at): one a record, source and URL."""
    key = ids.stable_id("evidence", F.lit(record_type), normalize_text(record_id), normalize_text("source_id"), normalize_text("source_url"))
    hashed = rows.join(hashes.select(F.col("url").alias("source_url"), "content_sha256").dropDuplicates(["source_url"]), "source_url", "left") if hashes is not None else rows.withColumn("content_sha256", F.lit(None).cast("string"))
    made = hashed.select(
        key.alias("evidence_id"), F.lit(record_type).alias("record_type"), F.col(record_id).alias("record_id"), F.lit("record").alias("field_name"), "source_id", "source_url", "observed_at",
        clean_text(snippet, 500).alias("snippet"), F.lit(None).cast("string").alias("selector"), confidence.alias("confidence"), "content_sha256", F.lit("0.1.0").alias("parser_version"), attribution.alias("attribution"),
    )
    return made.dropDuplicates(["evidence_id"])
