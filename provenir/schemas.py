"""Tables and in-flight records, with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = {
    "ingestion_runs": "run_id string, source_id string, started_at timestamp, finished_at timestamp, status string, full_snapshot boolean, "
    "fetched_count int, company_count int, job_count int, lead_count int, failure_count int, metrics_json string",
    "source_documents": "document_id string, run_id string, source_id string, url string, fetched_at timestamp, status_code int, content_type string, "
    "etag string, last_modified string, content_sha256 string, storage_pointer string, redistribution string, raw_retention_days int, parse_status string",
    "companies": "company_id string, canonical_name string, legal_name string, aliases array<string>, domain string, website string, careers_url string, "
    "sectors array<string>, nepal_relationship string, country string, locality string, address string, official_email string, official_phone string, "
    "profile string, active boolean, confidence double, first_seen_at timestamp, last_seen_at timestamp, primary_source_id string, primary_source_url string",
    "jobs": "job_id string, company_id string, title string, role_family string, seniority string, employment_type string, workplace_type string, "
    "location_text string, candidate_location string, eligibility string, eligibility_confidence double, eligibility_evidence string, "
    "eligibility_explanation string, eligibility_rule_version string, salary_text string, salary_min double, salary_max double, salary_currency string, "
    "salary_period string, skills array<string>, min_years_experience double, max_years_experience double, early_career_fit boolean, source_id string, "
    "source_url string, apply_url string, public_description string, posted_at timestamp, expires_at timestamp, first_seen_at timestamp, "
    "last_seen_at timestamp, status string, missing_runs int, fingerprint string, attribution string",
    "evidence": "evidence_id string, record_type string, record_id string, field_name string, source_id string, source_url string, observed_at timestamp, "
    "snippet string, selector string, confidence double, content_sha256 string, parser_version string, attribution string",
    "review_queue": "review_id string, kind string, source_id string, payload_json string, reason string, created_at timestamp, status string",
}
KEYS = {"ingestion_runs": "run_id", "source_documents": "document_id", "companies": "company_id", "jobs": "job_id", "evidence": "evidence_id", "review_queue": "review_id"}
#: Columns that rows are looked up by, beside the key.
INDEXES = {"companies": ("domain",), "jobs": ("fingerprint",)}

JOB_CANDIDATE = (
    "source_id string, source_url string, external_id string, company_name string, company_website string, title string, description string, "
    "apply_url string, location_text string, candidate_location string, employment_type string, workplace_type string, salary_text string, "
    "skills array<string>, posted_at timestamp, expires_at timestamp, observed_at timestamp, explicitly_closed boolean, description_public boolean, attribution string"
)
COMPANY_CANDIDATE = (
    "source_id string, source_url string, external_id string, name string, legal_name string, aliases array<string>, website string, careers_url string, "
    "sectors array<string>, nepal_relationship string, country string, locality string, address string, official_email string, official_phone string, "
    "profile string, confidence double, observed_at timestamp"
)
LEAD = "source_id string, source_url string, external_id string, query string, title string, payload string, observed_at timestamp"
ISSUE = "severity string, code string, message string, record_type string, record_id string"

#: Allowed texts of the enumerated columns.
DOMAINS = {
    "nepal_relationship": ("based", "operates", "hires", "unknown"),
    "eligibility": ("eligible", "likely", "unknown", "ineligible"),
    "workplace_type": ("remote", "hybrid", "onsite", "unknown"),
    "redistribution": ("attributed", "facts_only", "restricted", "unknown"),
    "status": ("active", "closed"),
}


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[name])
