"""Queries over connectors and over the rules as a whole: answers of feeds and boards are made of the documents, one answer each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import quality
from ..sources import feeds
from ..sources.catalog import Source
from .catalogue import B_COMPANIES, B_RUNS, TERMS, companies, query, runs, table

SHOWN = ("pos", "source_url", "external_id", "company_name", "title", "apply_url", "location_text", "employment_type", "salary_text")
#: Boards of these queries; languages without one have no board.
BOARDS = ["en", {"token": "de", "company": "Haus & Co"}, {"token": "fr", "company": "Maison", "website": "https://maison.example"}, "jobs"]
_FIRM = "CASE lang WHEN 'de' THEN 'Haus & Co' WHEN 'fr' THEN 'Maison' ELSE lang END"


def _source(connector: str, **more) -> Source:
    return Source(id=connector, name=connector, owner="o", kind="jobs", connector=connector, access_mode="api", attribution="by", redistribution="attributed", obey_robots=False, **more)


def _answers(spark, sf_dir: str, body: Column, url: Column | None = None) -> DataFrame:
    """Each document as one answer of a source."""
    at = F.lit("https://feed.example/").alias("url") if url is None else url.alias("url")
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq"), at, body.alias("content"), F.to_timestamp(F.lit("2026-01-01")).alias("observed_at"))


def _shown(jobs: DataFrame) -> DataFrame:
    """The texts of candidates, with a digest of the description, the skills in a row and the day of posting."""
    return jobs.select(*SHOWN, F.sha2("description", 256).alias("digest"), F.array_join("skills", ",").alias("skills"), F.date_format("posted_at", "yyyy-MM-dd HH:mm").alias("posted"))


def _job(**fields) -> Column:
    return F.struct(*(v.alias(k) if isinstance(v, Column) else F.lit(v).alias(k) for k, v in fields.items()))


def _id() -> Column:
    return F.col("doc_id").cast("string")


def _sql(pos: str, where: str, **columns: str) -> str:
    """The oracle of a connector: `columns` over documents; others are null."""
    made = [f"{columns.get(c, 'CAST(NULL AS VARCHAR)')} AS {c}" for c in (*SHOWN[1:], "digest", "skills", "posted")]
    return f"SELECT {pos} AS pos, {', '.join(made)} FROM documents WHERE {where}"


@query(_sql(
    "CAST(doc_id AS BIGINT) * 4294967296 + 1", "coalesce(source, '') <> '' AND coalesce(lang, '') <> ''", source_url="'https://r.example/' || doc_id", external_id="CAST(doc_id AS VARCHAR)", company_name="lang", title="source",
    apply_url="CASE WHEN doc_id % 2 = 0 THEN 'https://a.example/' || doc_id ELSE 'https://r.example/' || doc_id END", location_text="CASE WHEN doc_id % 3 = 0 THEN 'Asia' ELSE 'Worldwide' END", salary_text="doc_id || ' EUR'", digest="sha256(text)", skills="'a,' || source", posted="'2026-01-02 03:04'",
))
def feed_remoteok(spark, sf_dir):
    """A notice, a posting with some fields left out, and one without a position, which is skipped."""
    made = _job(id=_id(), position=F.col("source"), company=F.col("lang"), location=F.when(F.col("doc_id") % 3 == 0, "Asia"), description=F.col("text"), url=F.concat(F.lit("https://r.example/"), _id()), apply_url=F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("https://a.example/"), _id())), tags=F.array(F.lit("a"), F.col("source")), date="2026-01-02T03:04:00Z", salary=F.concat(_id(), F.lit(" EUR")))
    body = F.concat(F.lit('[{"legal": "n"}, '), F.to_json(made), F.lit(', {"position": "", "company": "x"}]'))
    return _shown(feeds.remoteok(_answers(spark, sf_dir, body), _source("remoteok")).jobs)


@query(_sql(
    "CAST(doc_id AS BIGINT) * 4294967296", "coalesce(source, '') <> '' AND coalesce(lang, '') <> ''", source_url="'https://m.example/' || doc_id", external_id="CAST(doc_id AS VARCHAR)", company_name="lang", title="source",
    apply_url="'https://m.example/' || doc_id", location_text="'Asia'", employment_type="'full_time'", salary_text="'5k'", digest="sha256(text)", skills="CASE WHEN doc_id % 2 = 0 THEN 'QA' ELSE '' END", posted="'2026-03-04 00:00'",
))
def feed_remotive(spark, sf_dir):
    """A posting, with or without a category, and one without a company, which is skipped."""
    made = _job(id=F.col("doc_id"), url=F.concat(F.lit("https://m.example/"), _id()), title=F.col("source"), company_name=F.col("lang"), category=F.when(F.col("doc_id") % 2 == 0, "QA"), job_type="full_time", publication_date="4 March 2026", candidate_required_location="Asia", salary="5k", description=F.col("text"))
    body = F.concat(F.lit('﻿{"job-count": 2, "jobs": ['), F.to_json(made), F.lit(', {"title": "alone", "url": "https://m.example/x"}]}'))
    return _shown(feeds.remotive(_answers(spark, sf_dir, body), _source("remotive")).jobs)


@query(_sql(
    "CAST(doc_id AS BIGINT) * 4294967296", "true", source_url="'https://h.example/' || doc_id", external_id="'g' || doc_id", company_name="CASE WHEN doc_id % 3 = 0 THEN 'Flat' ELSE 'Nested' END", title="'T' || doc_id", apply_url="'https://h.example/' || doc_id",
    location_text="CASE WHEN doc_id % 2 = 0 THEN 'Nepal, India' ELSE 'Anywhere' END", digest="sha256(text)", skills="CASE WHEN doc_id % 2 = 0 THEN 'x,y' ELSE '' END",
))
def feed_himalayas(spark, sf_dir):
    """Pages of either key, company as text or object, places as list or text, a day as an epoch number (no instant)."""
    even = F.col("doc_id") % 2 == 0
    company = F.when(F.col("doc_id") % 3 == 0, F.lit('"companyName": "Flat", ')).otherwise(F.lit('"company": {"name": "Nested", "website": "https://n.example"}, '))
    place = F.when(even, F.lit('"locationRestrictions": ["Nepal", "India"], "categories": ["x", "y"], ')).otherwise(F.lit('"location": "Anywhere", '))
    rest = F.to_json(_job(url=F.concat(F.lit("https://h.example/"), _id()), guid=F.concat(F.lit("g"), _id()), title=F.concat(F.lit("T"), _id()), description=F.col("text"), pubDate=1700000000))
    body = F.concat(F.lit('{"'), F.when(even, "jobs").otherwise("data"), F.lit('": [{'), company, place, F.substring(rest, F.lit(2), F.length(rest)), F.lit('], "nextCursor": null}'))
    return _shown(feeds.himalayas(_answers(spark, sf_dir, body), _source("himalayas")).jobs)


def _board(address: str) -> Column:
    return F.concat(F.lit(address.split("{}")[0]), F.coalesce("lang", F.lit("none")), F.lit(address.split("{}")[1]))


@query(_sql(
    "CAST(doc_id AS BIGINT) * 4294967296", "lang IN ('en', 'de', 'fr')", source_url="'https://b.example/' || doc_id", external_id="CAST(doc_id AS VARCHAR)", company_name=_FIRM, title="source", apply_url="'https://b.example/' || doc_id", location_text="'Here'", digest="sha256(text)", posted="'2026-02-01 00:00'"
))
def board_greenhouse(spark, sf_dir):
    made = _job(id=F.col("doc_id"), absolute_url=F.concat(F.lit("https://b.example/"), _id()), title=F.col("source"), content=F.col("text"), location=_job(name="Here"), updated_at="2026-02-01")
    body = F.concat(F.lit('{"jobs": ['), F.to_json(made), F.lit("]}"))
    return _shown(feeds.greenhouse(_answers(spark, sf_dir, body, _board("https://boards-api.greenhouse.io/v1/boards/{}/jobs?content=true")), _source("greenhouse", parameters={"boards": BOARDS})).jobs)


@query(_sql(
    "CAST(doc_id AS BIGINT) * 4294967296", "lang IN ('en', 'de', 'fr')", source_url="CASE WHEN doc_id % 2 = 0 THEN 'https://l.example/' || doc_id ELSE 'https://l.example/apply' END", external_id="CAST(doc_id AS VARCHAR)", company_name=_FIRM, title="source", apply_url="'https://l.example/apply'",
    location_text="'There'", employment_type="'Part-time'", digest="sha256(CASE WHEN coalesce(text, '') = '' THEN 'more' ELSE text || ' more' END)",
))
def board_lever(spark, sf_dir):
    made = _job(id=_id(), text=F.col("source"), description=F.col("text"), additional="more", hostedUrl=F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("https://l.example/"), _id())), applyUrl="https://l.example/apply", categories=_job(location="There", commitment="Part-time"), createdAt=1700000000000)
    body = F.concat(F.lit("["), F.to_json(made), F.lit("]"))
    return _shown(feeds.lever(_answers(spark, sf_dir, body, _board("https://api.lever.co/v0/postings/{}?mode=json")), _source("lever", parameters={"boards": BOARDS})).jobs)


@query(_sql(
    "CAST(doc_id AS BIGINT) * 4294967296", "lang IN ('en', 'de', 'fr')", source_url="'https://y.example/' || doc_id", external_id="'https://y.example/' || doc_id", company_name=_FIRM, title="source", apply_url="'https://y.example/' || doc_id", location_text="'Remote'", employment_type="'Contract'", digest="sha256(nullif(text, ''))", posted="'2026-05-06 05:08'"
))
def board_ashby(spark, sf_dir):
    made = _job(title=F.col("source"), location="Remote", jobUrl=F.concat(F.lit("https://y.example/"), _id()), descriptionHtml="", descriptionPlain=F.col("text"), employmentType="Contract", workplaceType="Remote", publishedAt="2026-05-06T07:08:09.5+02:00")
    body = F.concat(F.lit('{"jobs": ['), F.to_json(made), F.lit("]}"))
    return _shown(feeds.ashby(_answers(spark, sf_dir, body, _board("https://api.ashbyhq.com/posting-api/job-board/{}?includeCompensation=true")), _source("ashby", parameters={"boards": BOARDS})).jobs)


_CLOSED = ", ".join(repr(k) for k, v in TERMS.items() if v in ("restricted", "unknown"))


@query(
    f"""WITH companies AS ({B_COMPANIES}),
        jobs AS (SELECT o_orderkey AS job_id, o_clerk AS fingerprint, CASE WHEN o_totalprice > 1000 THEN 'title' END AS title, o_orderstatus = 'O' AS live, o_orderpriority = '5-LOW' AS shut, c_mktsegment AS source_id FROM (SELECT *, o_custkey % 97 AS o_clerk FROM orders) LEFT JOIN customer ON c_custkey = o_custkey),
        named AS (SELECT DISTINCT l_linenumber % 2 AS job, CASE WHEN l_linenumber % 2 = 1 THEN l_orderkey ELSE l_suppkey END AS id FROM lineitem WHERE l_linenumber < 3 AND l_quantity > 10),
        repeated AS (SELECT count(*) AS n FROM (SELECT fingerprint FROM jobs WHERE live GROUP BY fingerprint HAVING count(*) > 1)),
        whole AS (SELECT count(*) FILTER (canonical_name IS NOT NULL AND primary_source_id IS NOT NULL AND primary_source_url IS NOT NULL AND confidence IS NOT NULL) / count(*) AS ratio FROM companies WHERE active),
        filled AS (SELECT count(*) FILTER (title IS NOT NULL AND source_id IS NOT NULL) / count(*) AS ratio FROM jobs WHERE live AND NOT shut),
        drops AS (SELECT source_id FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY finished_at DESC, run_id DESC) AS r FROM ({B_RUNS})) WHERE r <= 2 GROUP BY source_id HAVING max(job_count) FILTER (r = 2) <> 0 AND max(job_count) FILTER (r = 1) / max(job_count) FILTER (r = 2) < 0.5),
        told AS (SELECT 'company_required_fields' AS code, 'company' AS record_type, CAST(company_id AS VARCHAR) AS record_id FROM companies WHERE canonical_name IS NULL OR primary_source_id IS NULL OR primary_source_url IS NULL
        UNION ALL SELECT 'company_provenance', 'company', CAST(company_id AS VARCHAR) FROM companies WHERE active AND company_id NOT IN (SELECT id FROM named WHERE job = 0)
        UNION ALL SELECT 'restricted_company_source', 'company', CAST(company_id AS VARCHAR) FROM companies WHERE primary_source_id IN ({_CLOSED})
        UNION ALL SELECT 'job_required_fields', 'job', CAST(job_id AS VARCHAR) FROM jobs WHERE live AND (title IS NULL OR source_id IS NULL)
        UNION ALL SELECT 'job_provenance', 'job', CAST(job_id AS VARCHAR) FROM jobs WHERE live AND job_id NOT IN (SELECT id FROM named WHERE job = 1)
        UNION ALL SELECT 'ineligible_active', 'job', CAST(job_id AS VARCHAR) FROM jobs WHERE live AND shut
        UNION ALL SELECT 'restricted_job_source', 'job', CAST(job_id AS VARCHAR) FROM jobs WHERE source_id IN ({_CLOSED})
        UNION ALL SELECT 'duplicate_key', 'evidence', l_orderkey || '/' || l_linenumber FROM lineitem WHERE l_linenumber < 3 AND l_quantity > 10 GROUP BY ALL HAVING count(*) > 1
        UNION ALL SELECT 'duplicate_jobs', NULL, NULL FROM repeated WHERE n > 0
        UNION ALL SELECT 'company_completeness', NULL, NULL FROM whole WHERE ratio < 0.95 UNION ALL SELECT 'job_completeness', NULL, NULL FROM filled WHERE ratio < 0.95
        UNION ALL SELECT 'source_catalog', NULL, NULL UNION ALL SELECT 'unexpected_source_drop', NULL, NULL FROM drops
        UNION ALL SELECT 'release_company_count', NULL, NULL WHERE (SELECT count(*) FROM companies WHERE active) < 500 UNION ALL SELECT 'release_job_count', NULL, NULL WHERE (SELECT count(*) FROM jobs WHERE live AND NOT shut) < 2000)
        SELECT code, record_type, record_id, CAST(count(*) AS BIGINT) AS n FROM told GROUP BY ALL"""
)
def validate_tables(spark, sf_dir):
    """Every rule over companies, postings, evidence and runs, as for a release."""
    text = lambda c: F.col(c).cast("string")
    owners = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("source_id"))
    jobs = table(spark, sf_dir, "orders").join(owners, "o_custkey", "left").select(
        text("o_orderkey").alias("job_id"), (F.col("o_custkey") % 97).alias("fingerprint"), F.when(F.col("o_totalprice") > 1000, "title").alias("title"), text("o_custkey").alias("company_id"), F.col("source_id"), F.col("source_id").alias("source_url"),
        F.when(F.col("o_orderstatus") == "O", "active").otherwise("closed").alias("status"), F.when(F.col("o_orderpriority") == "5-LOW", "ineligible").otherwise("eligible").alias("eligibility"), F.lit("e").alias("eligibility_evidence"), F.lit("r").alias("role_family"), F.col("o_orderdate").alias("last_seen_at"),
    )
    lines = table(spark, sf_dir, "lineitem").filter("l_linenumber < 3 and l_quantity > 10")
    is_job = F.col("l_linenumber") % 2 == 1
    evidence = lines.select(F.when(is_job, "job").otherwise("company").alias("record_type"), F.when(is_job, text("l_orderkey")).otherwise(text("l_suppkey")).alias("record_id"), F.concat_ws("/", "l_orderkey", "l_linenumber").alias("evidence_id"))
    found = {"companies": companies(spark, sf_dir).withColumn("company_id", text("company_id")), "jobs": jobs, "evidence": evidence, "ingestion_runs": runs(spark, sf_dir)}
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("id"), F.lit("attributed").alias("redistribution")).distinct()
    terms = spark.createDataFrame(list(TERMS.items()), "id string, redistribution string").unionByName(events)
    issues, _ = quality.validate(found, terms, ["no maintainer"], release=True)
    return issues.groupBy("code", "record_type", "record_id").agg(F.count("*").alias("n"))
