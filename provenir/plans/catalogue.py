"""The engine's queries by name, each with the SQL it must agree with where SQL can say it.

The tables at hand hold no postings, so the operators are bound to views of them: documents with postings' texts by
number, customers and suppliers as companies, events as runs and snapshots, orders and lines as evidence.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, ids, rules, text, urls
from ..operators import jobs as postings_of
from ..operators import lifecycle, quality, resolution, upsert
from ..schemas import empty
from ..sinks import export
from ..staging import staged
from . import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its oracle."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Posting texts, taken by the documents in turn: title, description, location, candidate location, type, salary.
POSTINGS = (
    ("machine learning engineer", "requires 1-2 years experience with python and aws", "remote", "worldwide", "full time", "USD 40k - 60k per year"),
    ("junior software developer", "react, node.js and postgresql. at least 3 years", "remote", "us only", "contract", "$30/hour"),
    ("senior sre", "kubernetes on gcp, 5+ years. hybrid", "kathmandu", "nepal", "permanent", "npr 120000 per month"),
    ("product owner", "4 years of experience. must be in the united states", "berlin", "", "part-time", "€50,000 annual"),
    ("cook", "kitchen work on-site", "paris", "", "internal", ""),
    ("qa engineer", "selenium and c#, distributed team", "", "asia-pacific", "freelance", "£45k"),
    ("head of engineering", "golang, rust, docker. work from anywhere", "", "", "trainee", "competitive"),
    ("helpdesk intern", "it support, minimum 1 years", "remote in canada", "canada residents only", "", "INR 20000 - 30000 /month"),
    ("ux designer", "typescript and generative ai. remote", "remote", "remote", "temporary", "AUD 90k"),
    ("penetration tester", "appsec, intermediate level, office based", "pune", "anywhere", "odd job", "100 per hour"),
)
_COLUMNS = ("title", "description", "location_text", "candidate_location", "employment_type", "salary_text")
_VALUES = ", ".join("(" + ", ".join([str(k), *("'" + v.replace("'", "''") + "'" for v in row)]) + ")" for k, row in enumerate(POSTINGS))
B_POSTINGS = f"""SELECT d.doc_id, d.source AS source_id, p.title, p.description, p.location_text, p.candidate_location, p.employment_type, p.salary_text,
  p.title || ' ' || p.description AS body
  FROM documents d JOIN (VALUES {_VALUES}) AS p(k, {', '.join(_COLUMNS)}) ON d.doc_id % {len(POSTINGS)} = p.k"""


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(B_POSTINGS.replace("documents d", "{documents} d"), documents=table(spark, sf_dir, "documents"))


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as companies: active with a balance, named after their market where it is not negative."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("company_id"), F.when(F.col("c_acctbal") > -900, F.col("c_name")).alias("canonical_name"), (F.col("c_acctbal") > 0).alias("active"),
        F.col("c_mktsegment").alias("primary_source_id"), F.when(F.col("c_acctbal") < 9900, F.concat(F.lit("https://example.com/"), F.col("c_custkey"))).alias("primary_source_url"), F.col("c_acctbal").alias("confidence"),
    )


B_COMPANIES = """SELECT c_custkey AS company_id, CASE WHEN c_acctbal > -900 THEN c_name END AS canonical_name, c_acctbal > 0 AS active, c_mktsegment AS primary_source_id,
  CASE WHEN c_acctbal < 9900 THEN 'https://example.com/' || c_custkey END AS primary_source_url, c_acctbal AS confidence FROM customer"""
#: Fixed by these queries: terms of the sources that companies come from.
TERMS = {"AUTOMOBILE": "attributed", "BUILDING": "restricted", "FURNITURE": "facts_only", "HOUSEHOLD": "unknown", "MACHINERY": "attributed"}
B_RUNS = """SELECT event_type AS source_id, event_type || '/' || CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, 'completed' AS status, CAST(ts AS DATE) AS finished_at, count(*) AS job_count
  FROM events GROUP BY event_type, CAST(ts AS DATE)"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("ts")
    e = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("source_id"), day.alias("finished_at")).agg(F.count("*").alias("job_count"))
    return e.withColumn("run_id", F.concat_ws("/", "source_id", F.col("finished_at").cast("string"))).withColumn("status", F.lit("completed"))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_type").alias("source_id"), F.to_date("ts").alias("run_day"), F.col("user_id").alias("job_id")).distinct()


# Public datasets and counts


class _Bound(dict):
    """The tables that the public views and counts read, bound to those at hand; each is made when it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.of = lambda name: table(spark, sf_dir, name)
        self.companies, self.runs = lambda: companies(spark, sf_dir), lambda: runs(spark, sf_dir)

    def __missing__(self, name: str) -> DataFrame:
        self[name] = made = getattr(self, f"_{name}")()
        return made

    def _companies(self) -> DataFrame:
        return self.companies()

    def _jobs(self) -> DataFrame:
        return self.of("orders").select(
            F.col("o_orderkey").alias("job_id"), F.col("o_custkey").alias("company_id"), F.when(F.col("o_orderstatus") == "O", "active").otherwise("closed").alias("status"),
            F.when(F.col("o_orderpriority") == "5-LOW", "ineligible").otherwise("eligible").alias("eligibility"), F.col("o_totalprice"), F.col("o_orderdate").alias("last_seen_at"), F.col("o_orderpriority"), F.lit("").alias("public_description"),
        )

    def _evidence(self) -> DataFrame:
        even = F.col("l_linenumber") % 2 == 0
        return self.of("lineitem").select(F.when(even, "company").otherwise("job").alias("record_type"), F.when(even, F.col("l_suppkey")).otherwise(F.col("l_orderkey")).alias("record_id"), F.concat_ws("/", "l_orderkey", "l_linenumber").alias("evidence_id"))

    def _review_queue(self) -> DataFrame:
        return self.of("events").select(F.col("event_id").alias("review_id"), F.when(F.col("event_type") == "click", "pending").otherwise("done").alias("status"), F.col("ts").alias("created_at"), "user_id")

    def _ingestion_runs(self) -> DataFrame:
        held = self.runs().withColumn("started_at", F.col("finished_at")).withColumn("metrics_json", F.lit("{}"))
        return held.withColumn("status", F.when(F.col("job_count") < 20, "failed").otherwise("completed"))


def bound_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _Bound(spark, sf_dir)


@query(f"SELECT * FROM ({B_COMPANIES}) WHERE active ORDER BY canonical_name, company_id")
def export_companies(spark, sf_dir):
    return export.public_view(bound_tables(spark, sf_dir), "companies")


@query(
    """SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority FROM orders
       WHERE o_orderstatus = 'O' AND o_orderpriority <> '5-LOW' ORDER BY o_orderdate DESC, o_orderkey"""
)
def export_jobs(spark, sf_dir):
    jobs = export.public_view(bound_tables(spark, sf_dir), "jobs")
    return jobs.select(F.col("job_id").alias("o_orderkey"), F.col("company_id").alias("o_custkey"), "o_totalprice", F.col("last_seen_at").alias("o_orderdate"), "o_orderpriority")


_STATUS = "CASE WHEN job_count < 20 THEN 'failed' ELSE 'completed' END"


@query(f"SELECT run_id, source_id, {_STATUS} AS status, finished_at, job_count FROM ({B_RUNS}) ORDER BY finished_at DESC, run_id")
def export_runs(spark, sf_dir):
    return export.public_view(bound_tables(spark, sf_dir), "runs").select("run_id", "source_id", "status", "finished_at", "job_count")


@query(
    """SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'company' ELSE 'job' END AS record_type, CASE WHEN l_linenumber % 2 = 0 THEN l_suppkey ELSE l_orderkey END AS record_id, l_orderkey || '/' || l_linenumber AS evidence_id FROM lineitem
       WHERE CASE WHEN l_linenumber % 2 = 0 THEN l_suppkey ELSE l_orderkey END IN
       (SELECT c_custkey FROM customer WHERE c_acctbal > 0 UNION ALL SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority <> '5-LOW')"""
)
def export_evidence(spark, sf_dir):
    return export.public_view(bound_tables(spark, sf_dir), "evidence")


@query("SELECT event_id, ts, user_id FROM events WHERE event_type = 'click' ORDER BY ts, event_id")
def review_pending(spark, sf_dir):
    return export.pending_reviews(bound_tables(spark, sf_dir)).select(F.col("review_id").alias("event_id"), F.col("created_at").alias("ts"), "user_id")


@query(
    f"""SELECT (SELECT count(*) FROM customer WHERE c_acctbal > 0) AS companies, (SELECT count(*) FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority <> '5-LOW') AS active_jobs,
       (SELECT count(*) FROM events WHERE event_type = 'click') AS pending_review, (SELECT count(*) FROM ({B_RUNS}) WHERE job_count < 20) AS failed_runs"""
)
def stats_overview(spark, sf_dir):
    found = ingest.stats(bound_tables(spark, sf_dir))
    return spark.range(1).select(*(F.lit(n).cast("long").alias(k) for k, n in found.items()))


# Quality rules


@query("SELECT c.c_custkey FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F' WHERE c.c_acctbal > 0 GROUP BY c.c_custkey HAVING count(o.o_orderkey) = 0")
def provenance_missing_company(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").filter("c_acctbal > 0")
    evidence = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("record_type"), F.col("o_custkey").alias("record_id"), F.col("o_orderkey").alias("evidence_id"))
    return quality.without_evidence(rows, "c_custkey", evidence, "F")


@query("SELECT p.p_partkey FROM part p LEFT JOIN lineitem l ON l.l_partkey = p.p_partkey AND l.l_quantity = 50 WHERE p.p_size > 10 GROUP BY p.p_partkey HAVING count(l.l_orderkey) = 0")
def provenance_missing_job(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_quantity").alias("record_type"), F.col("l_partkey").alias("record_id"), F.col("l_orderkey").alias("evidence_id"))
    return quality.without_evidence(table(spark, sf_dir, "part").filter("p_size > 10"), "p_partkey", lines, 50)


@query("SELECT p_brand || '|' || p_type AS fingerprint, count(*) AS n FROM part GROUP BY p_brand || '|' || p_type HAVING count(*) > 1")
def duplicate_fingerprints(spark, sf_dir):
    return quality.duplicate_fingerprints(table(spark, sf_dir, "part").select(F.concat_ws("|", "p_brand", "p_type").alias("fingerprint")))


@query(f"SELECT company_id FROM ({B_COMPANIES}) WHERE canonical_name IS NULL OR primary_source_url IS NULL OR primary_source_id IS NULL")
def required_fields_issues(spark, sf_dir):
    return quality.missing_fields(companies(spark, sf_dir), "company_id", quality.COMPANY_FIELDS[:3])


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'O'")
def ineligible_active(spark, sf_dir):
    return table(spark, sf_dir, "orders").filter("o_orderpriority = '5-LOW' and o_orderstatus = 'O'").select("o_orderkey")


@query(f"SELECT company_id FROM ({B_COMPANIES}) WHERE primary_source_id IN ({', '.join(repr(k) for k, v in TERMS.items() if v in quality.RESTRICTED)})")
def restricted_source_rows(spark, sf_dir):
    terms = spark.createDataFrame(list(TERMS.items()), "id string, redistribution string")
    return quality.from_restricted(companies(spark, sf_dir), "company_id", "primary_source_id", terms)


@query(f"SELECT count(*) AS total, count(*) FILTER (canonical_name IS NOT NULL AND primary_source_id IS NOT NULL AND primary_source_url IS NOT NULL AND confidence IS NOT NULL) AS complete, round(complete / total, 9) AS ratio FROM ({B_COMPANIES})")
def completeness_ratio(spark, sf_dir):
    return quality.completeness(companies(spark, sf_dir), quality.COMPANY_FIELDS).withColumn("ratio", F.round("ratio", 9))


@query(
    f"""SELECT source_id, max(CASE WHEN r = 1 THEN job_count END) AS newest, max(CASE WHEN r = 2 THEN job_count END) AS previous, round(newest / previous, 9) AS ratio FROM
        (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY finished_at DESC, run_id DESC) AS r FROM ({B_RUNS})) WHERE r <= 2 GROUP BY source_id HAVING previous <> 0"""
)
def source_drop_latest_two(spark, sf_dir):
    return quality.latest_two(runs(spark, sf_dir)).withColumn("ratio", F.round("ratio", 9))


# State


@query(
    """WITH s AS (SELECT DISTINCT event_type AS source_id, CAST(ts AS DATE) AS run_day, user_id AS job_id FROM events),
       runs AS (SELECT source_id, run_day, row_number() OVER (PARTITION BY source_id ORDER BY run_day) AS run FROM (SELECT DISTINCT source_id, run_day FROM s)),
       seen AS (SELECT source_id, job_id, min(run_day) AS first_day, max(run_day) AS last_day FROM s GROUP BY ALL),
       missed AS (SELECT seen.*, least(2, (SELECT max(run) FROM runs q WHERE q.source_id = seen.source_id) - run) AS missing_runs FROM seen JOIN runs ON runs.source_id = seen.source_id AND run_day = last_day)
       SELECT source_id, job_id, first_day, last_day, missing_runs, CASE WHEN missing_runs >= 2 THEN 'closed' ELSE 'active' END AS status FROM missed"""
)
def lifecycle_status(spark, sf_dir):
    return lifecycle.history(snapshots(spark, sf_dir))


@query(
    """WITH last AS (SELECT event_type, max(CAST(ts AS DATE)) AS d FROM events GROUP BY 1), observed AS (SELECT DISTINCT user_id FROM events JOIN last USING (event_type) WHERE event_type = 'click' AND CAST(ts AS DATE) = d)
       SELECT c_custkey AS job_id, CASE WHEN c_nationkey < 15 THEN 'click' ELSE 'other' END AS source_id,
       CASE WHEN miss AND c_nationkey % 2 + 1 >= 2 THEN 'closed' ELSE st END AS status, CASE WHEN miss THEN c_nationkey % 2 + 1 ELSE c_nationkey % 2 END AS missing_runs
       FROM (SELECT *, CASE WHEN c_acctbal > 0 THEN 'active' ELSE 'closed' END AS st, c_nationkey < 15 AND c_acctbal > 0 AND c_custkey NOT IN (SELECT user_id FROM observed) AS miss FROM customer)"""
)
def lifecycle_step(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    jobs = c.select(F.col("c_custkey").alias("job_id"), F.when(F.col("c_nationkey") < 15, "click").otherwise("other").alias("source_id"), F.when(F.col("c_acctbal") > 0, "active").otherwise("closed").alias("status"), (F.col("c_nationkey") % 2).alias("missing_runs"))
    own = snapshots(spark, sf_dir).filter("source_id = 'click'")
    observed = own.join(own.agg(F.max("run_day").alias("run_day")), "run_day").select("job_id")
    return lifecycle.age_missing(jobs, observed, "click")


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def upsert_last_wins(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    old, new = e.filter("event_id % 2 = 0"), e
    before = upsert.last_per_key(old, "user_id", "ts", "event_id")
    return upsert.upsert(before, upsert.last_per_key(new, "user_id", "ts", "event_id"), "user_id").select("user_id", "event_id", "event_type", "value")


@query("SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey + 1000, s_name FROM supplier WHERE s_suppkey + 1000 NOT IN (SELECT c_custkey FROM customer)")
def upsert_do_nothing(spark, sf_dir):
    old = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return upsert.insert_missing(old, table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 1000).alias("id"), F.col("s_name").alias("name")), "id")


@query(
    """SELECT c_custkey AS id, c_name AS name, coalesce(s_acctbal, c_acctbal) AS balance FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey"""
)
def document_upsert(spark, sf_dir):
    old = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    new = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return upsert.upsert_columns(old, new, "id", ["balance"])


@query("SELECT user_id, min(event_type) AS fingerprint, arg_min(event_id, (ts, event_id)) AS job_id, min(ts) AS first_seen_at FROM events GROUP BY user_id")
def fingerprint_first_seen(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("event_type").alias("fingerprint"), F.min_by("event_id", F.struct("ts", "event_id")).alias("job_id"), F.min("ts").alias("first_seen_at"))


_NAMED = "CASE event_type WHEN 'click' THEN 'lever' WHEN 'view' THEN 'remoteok' WHEN 'purchase' THEN 'ashby' ELSE event_type END"


@query(f"SELECT user_id, source_id, CASE WHEN source_id IN ('greenhouse', 'lever', 'ashby') THEN 100 WHEN source_id IN ('himalayas', 'remoteok', 'remotive') THEN 50 ELSE 75 END AS priority FROM (SELECT user_id, {_NAMED} AS source_id, row_number() OVER (PARTITION BY user_id ORDER BY CASE {_NAMED} WHEN 'lever' THEN 100 WHEN 'ashby' THEN 100 WHEN 'remoteok' THEN 50 ELSE 75 END DESC, ts, event_id) AS r FROM events) WHERE r = 1")
def source_priority_pick(spark, sf_dir):
    named = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", F.expr(_NAMED).alias("source_id")).withColumn("priority", rules.source_priority(F.col("source_id")))
    best = named.groupBy("user_id").agg(F.min_by(F.struct("source_id", "priority"), F.struct(-F.col("priority"), "ts", "event_id")).alias("b"))
    return best.select("user_id", "b.source_id", "b.priority")


# Functions

_URL = r"^(https?)://([^/?#]+)([^?#]*)(?:\?([^#]*))?"
_KEPT = "list_filter(string_split(regexp_extract(url, '" + _URL + "', 4), '&'), lambda p: p <> '' AND NOT list_contains([" + ", ".join(f"'{t}'" for t in urls.TRACKING) + "], lower(split_part(p, '=', 1))) AND NOT starts_with(lower(split_part(p, '=', 1)), 'utm_'))"
_CANONICAL = f"""regexp_extract(url, '{_URL}', 1) || '://' || lower(regexp_extract(url, '{_URL}', 2)) ||
  CASE WHEN trim(regexp_extract(url, '{_URL}', 3), '/') = '' THEN '/' ELSE rtrim(regexp_replace(regexp_extract(url, '{_URL}', 3), '/+', '/', 'g'), '/') END ||
  CASE WHEN len({_KEPT}) = 0 THEN '' ELSE '?' || array_to_string(list_sort({_KEPT}), '&') END"""


@query(f"SELECT page_id, {_CANONICAL} AS canonical FROM pages")
def canonical_url(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.canonical_url(F.col("url")).alias("canonical"))


@query(f"SELECT regexp_replace(lower(regexp_extract(url, '{_URL}', 2)), '^www\\.', '') AS domain, count(*) AS pages, count(DISTINCT {_CANONICAL}) AS urls FROM pages GROUP BY 1")
def domain_group(spark, sf_dir):
    made = table(spark, sf_dir, "pages").select(urls.canonical_url(F.col("url")).alias("u"))
    return made.groupBy(urls.domain_of(F.col("u")).alias("domain")).agg(F.count("*").alias("pages"), F.countDistinct("u").alias("urls"))


_HASH = "sha1(unhex('55a45f42cbd54f91a2e3665fd125ba16') || encode('company|' || lower(c_name) || '|' || c_nationkey))"


@query(
    f"""SELECT c_custkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', CAST('0x' || substr(h, 17, 1) AS INT) % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS company_id
        FROM (SELECT c_custkey, {_HASH} AS h FROM customer)"""
)
def stable_uuid5(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", ids.stable_id("company", text.normalize_ascii(F.col("c_name")), F.col("c_nationkey").cast("string")).alias("company_id"))


@query("SELECT page_id, octet_length(encode(html)) AS bytes, sha256(html) AS sha256 FROM pages")
def content_sha256_manifest(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.octet_length("html").cast("long").alias("bytes"), ids.content_hash(F.col("html").cast("binary")).alias("sha256"))


def _re2(words) -> str:
    return r"(^|[^\p{L}\p{N}_])(" + "|".join(text.escaped(w) for w in words) + r")($|[^\p{L}\p{N}_])"


def _case(expression: str, patterns: dict[str, str], otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({expression}, '{p}') THEN '{k}'" for k, p in patterns.items()) + f" ELSE {otherwise} END"


@query(f"SELECT doc_id, {_case('body', {k: _re2(v) for k, v in rules.ROLES.items()}, repr('other'))} AS role_family FROM ({B_POSTINGS})")
def classify_role(spark, sf_dir):
    return postings(spark, sf_dir).select("doc_id", rules.classify_role(F.col("body")).alias("role_family"))


@query(f"SELECT doc_id, {_case('body', {k: _re2(v) for k, v in rules.SENIORITY.items()}, repr('unspecified'))} AS seniority FROM ({B_POSTINGS})")
def classify_seniority(spark, sf_dir):
    return postings(spark, sf_dir).select("doc_id", rules.classify_seniority(F.col("body")).alias("seniority"))


_SKILLS = ", ".join(f"CASE WHEN regexp_matches(body, '{_re2(v)}') THEN '{k}' END" for k, v in sorted(rules.SKILLS.items()))


@query(f"SELECT doc_id, array_to_string(list_filter([{_SKILLS}], lambda s: s IS NOT NULL), ',') AS skills FROM ({B_POSTINGS})")
def extract_skills(spark, sf_dir):
    return postings(spark, sf_dir).select("doc_id", F.array_join(rules.extract_skills(F.col("body")), ",").alias("skills"))


def _years(k: int) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(description, '{f[0]}') THEN " + (f"CAST(regexp_extract(description, '{f[0]}', {f[k]}) AS DOUBLE)" if f[k] else "NULL") for f in rules.EXPERIENCE) + " END"


@query(f"SELECT doc_id, {_years(1)} AS min_years, {_years(2)} AS max_years FROM ({B_POSTINGS})")
def extract_experience(spark, sf_dir):
    y = rules.extract_experience(F.col("description"))
    return postings(spark, sf_dir).select("doc_id", y["min"].alias("min_years"), y["max"].alias("max_years"))


_PAY = "replace(salary_text, ',', '')"
_AMOUNT = f"list_transform(regexp_extract_all({_PAY}, '\\d+(?:\\.\\d+)?\\s*[kK]?'), lambda m: CAST(regexp_extract(m, '^(\\d+(?:\\.\\d+)?)', 1) AS DOUBLE) * CASE WHEN regexp_matches(m, '[kK]$') THEN 1000 ELSE 1 END)"
_CODE = r"(?i)\b(USD|NPR|EUR|GBP|INR|AUD|CAD)\b|([$€£])"


@query(
    f"""SELECT doc_id, {_AMOUNT}[1] AS low, {_AMOUNT}[2] AS high,
        CASE upper(regexp_extract({_PAY}, '{_CODE}', 0)) WHEN '' THEN NULL WHEN '$' THEN 'USD' WHEN '€' THEN 'EUR' WHEN '£' THEN 'GBP' ELSE upper(regexp_extract({_PAY}, '{_CODE}', 0)) END AS currency,
        CASE WHEN regexp_matches({_PAY}, '(?i)(?:/|per\\s+)hour|annual') THEN 'hour' WHEN regexp_matches({_PAY}, '(?i)(?:/|per\\s+)month') THEN 'month' WHEN regexp_matches({_PAY}, '(?i)(?:/|per\\s+)year') THEN 'year' END AS period
        FROM ({B_POSTINGS})"""
)
def parse_salary(spark, sf_dir):
    p = rules.parse_salary(F.col("salary_text"))
    return postings(spark, sf_dir).select("doc_id", p["min"].alias("low"), p["max"].alias("high"), p["currency"].alias("currency"), p["period"].alias("period"))


_EVIDENCE = "left(concat_ws(' | ', nullif(candidate_location, ''), nullif(location_text, ''), nullif(description, '')), 1000)"
_FOUND = lambda patterns: "coalesce(" + ", ".join(f"nullif(regexp_extract({_EVIDENCE}, '{p}'), '')" for p in patterns) + ")"
_PLACE = _case("body", rules.WORKPLACE, repr("unknown"))


@query(
    f"""SELECT doc_id, CASE WHEN a IS NOT NULL THEN 'ineligible' WHEN b IS NOT NULL THEN 'eligible' WHEN w = 'onsite' THEN 'ineligible' WHEN c IS NOT NULL THEN 'likely' ELSE 'unknown' END AS eligibility,
        CASE WHEN a IS NOT NULL THEN 0.98 WHEN b IS NOT NULL THEN 0.95 WHEN w = 'onsite' THEN 0.9 WHEN c IS NOT NULL THEN 0.65 ELSE 0.35 END::DOUBLE AS confidence,
        CASE WHEN a IS NOT NULL THEN a WHEN b IS NOT NULL THEN b WHEN w = 'onsite' THEN coalesce(nullif(location_text, ''), 'onsite') WHEN c IS NOT NULL THEN c ELSE left(coalesce(nullif(candidate_location, ''), nullif(location_text, ''), 'No geographic evidence'), 300) END AS evidence
        FROM (SELECT *, {_FOUND(rules.INELIGIBLE)} AS a, {_FOUND(rules.ELIGIBLE)} AS b, {_FOUND(rules.LIKELY)} AS c, {_PLACE} AS w FROM ({B_POSTINGS}))"""
)
def assess_eligibility(spark, sf_dir):
    rows = postings(spark, sf_dir).withColumn("w", rules.infer_workplace(F.col("body"))).withColumn("e", rules.evidence_text(F.col("candidate_location"), F.col("location_text"), F.col("description")))
    v = rules.eligibility(F.col("e"), F.col("w"), F.col("candidate_location"), F.col("location_text"))
    return rows.withColumn("v", v).select("doc_id", F.col("v.status").alias("eligibility"), F.col("v.confidence").alias("confidence"), F.col("v.evidence").alias("evidence"))


@query(f"SELECT doc_id, {_PLACE} AS workplace_type FROM ({B_POSTINGS})")
def infer_workplace(spark, sf_dir):
    return postings(spark, sf_dir).select("doc_id", rules.infer_workplace(F.col("body")).alias("workplace_type"))


@query(f"SELECT doc_id, CASE WHEN employment_type = '' THEN NULL ELSE {_case('employment_type', {k: '|'.join(v) for k, v in rules.EMPLOYMENT.items()}, 'left(employment_type, 50)')} END AS employment_type FROM ({B_POSTINGS})")
def normalize_employment(spark, sf_dir):
    return postings(spark, sf_dir).select("doc_id", rules.employment_type(F.col("employment_type")).alias("employment_type"))


@query(f"SELECT doc_id, coalesce({_case('body', {k: _re2(v) for k, v in rules.SENIORITY.items()}, repr('unspecified'))} IN ('intern', 'entry') OR {_years(1)} <= 2, false) AS early FROM ({B_POSTINGS})")
def early_career(spark, sf_dir):
    return postings(spark, sf_dir).select("doc_id", rules.is_early_career(rules.classify_seniority(F.col("body")), rules.extract_experience(F.col("description"))["min"]).alias("early"))


@query(r"SELECT doc_id, regexp_matches(text, '(^|[^\p{L}\p{N}_])(the|und|que)($|[^\p{L}\p{N}_])') AS found FROM documents")
def keyword_match(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").rlike(text.keywords(("the", "und", "que"))).alias("found"))


@query("SELECT c_custkey, CASE WHEN c_nationkey % 5 = 0 THEN NULL WHEN c_nationkey % 5 = 1 THEN NULL ELSE 'info' || c_custkey || '@' || CASE WHEN c_nationkey % 5 = 2 THEN 'hr.' ELSE '' END || 'example.com' END AS email FROM customer")
def organization_email(spark, sf_dir):
    kind = F.col("c_nationkey") % 5
    local = F.when(kind == 1, "Recruiter").otherwise("Info")
    host = F.when(kind == 0, "other.org").when(kind == 2, "HR.example.com").otherwise("example.com")
    address = F.concat(F.lit(" "), local, F.col("c_custkey").cast("string"), F.lit("@"), host)
    return table(spark, sf_dir, "customer").select("c_custkey", rules.organization_email(address, F.lit("example.com")).alias("email"))


@query(f"SELECT source_id, count(*) AS seen, count(*) FILTER (role = 'other') AS skipped FROM (SELECT source_id, {_case('body', {k: _re2(v) for k, v in rules.ROLES.items()}, repr('other'))} AS role FROM ({B_POSTINGS})) GROUP BY source_id")
def nontech_skip_counts(spark, sf_dir):
    rows = postings(spark, sf_dir).withColumn("role", rules.classify_role(F.col("body")))
    return rows.groupBy("source_id").agg(F.count("*").alias("seen"), F.count_if(F.col("role") == "other").alias("skipped"))


@query(f"SELECT audited, count(*) AS n FROM (SELECT {_FOUND(rules.INELIGIBLE)} IS NOT NULL AS audited FROM ({B_POSTINGS})) GROUP BY audited")
def ineligible_audit_split(spark, sf_dir):
    rows = postings(spark, sf_dir).withColumn("e", rules.evidence_text(F.col("candidate_location"), F.col("location_text"), F.col("description")))
    v = rules.eligibility(F.col("e"), F.lit("remote"), F.col("candidate_location"), F.col("location_text"))
    return rows.select((v["confidence"] == 0.98).alias("audited")).groupBy("audited").agg(F.count("*").alias("n"))


@query("SELECT event_type, isoyear(ts) AS iso_year, weekofyear(ts) AS iso_week, count(*) AS n FROM events GROUP BY ALL")
def weekly_runs(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy("event_type", F.extract(F.lit("YEAROFWEEK"), "ts").cast("long").alias("iso_year"), F.weekofyear("ts").cast("long").alias("iso_week")).agg(F.count("*").alias("n"))


_RUN = "sha1(unhex('55a45f42cbd54f91a2e3665fd125ba16') || encode('run|' || event_type || '|' || isoyear(ts) || '|' || weekofyear(ts)))"


@query(
    f"""SELECT DISTINCT source_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', CAST('0x' || substr(h, 17, 1) AS INT) % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS run_id
        FROM (SELECT event_type AS source_id, {_RUN} AS h FROM events)"""
)
def weekly_run_id(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("source_id"), ids.weekly_run_id(F.col("event_type"), F.to_date("ts")).alias("run_id")).distinct()


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events")
def job_feed_explode(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query(
    """SELECT CAST(c_nationkey AS VARCHAR) AS company_id, arg_min(c_name, c_custkey) AS canonical_name, array_to_string(list_sort(list_filter(list_distinct(list(c_name)), lambda n: n <> arg_min(c_name, c_custkey))), ',') AS aliases,
       array_to_string(list_sort(list_distinct(list(c_mktsegment))), ',') AS sectors, max(c_acctbal) AS confidence, arg_max(c_name, c_custkey) FILTER (c_custkey % 3 = 0) AS profile,
       coalesce(arg_max(CASE WHEN c_custkey % 2 = 0 THEN 'based' END, c_custkey) FILTER (c_custkey % 2 = 0), 'unknown') AS nepal_relationship, count(*) FILTER (c_custkey < 0) AS lost FROM customer GROUP BY c_nationkey"""
)
def company_merge(spark, sf_dir):
    """Customers as candidates resolved to their nation, through the merge of companies."""
    c, none = table(spark, sf_dir, "customer"), F.lit(None).cast("string")
    seen = F.to_timestamp(F.lit("2026-01-01"))
    resolved = c.select(
        F.col("c_nationkey").cast("string").alias("company_id"), F.col("c_custkey").alias("pos"), F.col("c_name").alias("name"), none.alias("legal_name"), F.array().cast("array<string>").alias("aliases"),
        *(none.alias(k) for k in ("domain", "website", "careers_url", "country", "locality", "address", "official_email", "official_phone")), F.array("c_mktsegment").alias("sectors"),
        F.when(F.col("c_custkey") % 2 == 0, "based").otherwise("unknown").alias("nepal_relationship"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).otherwise("").alias("profile"),
        F.col("c_acctbal").alias("confidence"), seen.alias("observed_at"), F.lit("s").alias("source_id"), F.lit("https://example.com/").alias("source_url"),
    )
    made = resolution.merge(empty(spark, "companies"), resolved)
    return made.select("company_id", "canonical_name", F.array_join("aliases", ",").alias("aliases"), F.array_join("sectors", ",").alias("sectors"), "confidence", "profile", "nepal_relationship", F.lit(0).cast("long").alias("lost"))


_PRIORITY = "CASE WHEN {0} IN ('greenhouse', 'lever', 'ashby') THEN 100 WHEN {0} IN ('himalayas', 'remoteok', 'remotive') THEN 50 ELSE 75 END"


@query(
    f"""WITH e AS (SELECT event_id, user_id, ts, {_NAMED} AS src FROM events),
        k AS (SELECT user_id, arg_min(event_id, (ts, event_id)) AS id, min(ts) AS seen, arg_min(src, (ts, event_id)) AS src FROM e WHERE event_id % 10 = 0 GROUP BY user_id),
        f AS (SELECT user_id, min(event_id) AS id, arg_min(ts, event_id) AS seen, arg_max(src, event_id) AS src FROM e WHERE event_id % 10 <> 0 GROUP BY user_id)
        SELECT f.user_id AS fingerprint, coalesce(k.id, f.id) AS job_id, coalesce(k.seen, f.seen) AS first_seen_at,
        CASE WHEN k.id IS NOT NULL AND {_PRIORITY.format('k.src')} > {_PRIORITY.format('f.src')} THEN k.src ELSE f.src END AS source_id FROM f LEFT JOIN k USING (user_id)"""
)
def job_deduplicate(spark, sf_dir):
    """Events as postings with their user as fingerprint: a tenth of them is known, the others are one batch."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("fingerprint"), F.col("event_id").alias("job_id"), F.col("ts").alias("first_seen_at"), F.expr(_NAMED).alias("source_id"), F.lit("u").alias("source_url"), F.lit("by").alias("attribution"))
    fresh = e.filter("job_id % 10 <> 0").withColumn("pos", F.col("job_id"))
    return postings_of.deduplicate(e.filter("job_id % 10 = 0"), fresh).select("fingerprint", "job_id", "first_seen_at", "source_id")


#: Company names of documents: the first words of a text in ASCII letters and digits, in lower case.
_NAME_WORDS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+')"
#: Common subsequence of a and b by rows of bits (names of up to 100 letters), and the token-set score made of it.
_HIT = "(v & list_sum(list_transform(range(length(a)), lambda i: CASE WHEN substr(a, CAST(i + 1 AS INT), 1) = c THEN CAST(1 AS HUGEINT) << CAST(i AS INT) ELSE 0 END))::HUGEINT)"
_FULL = "((CAST(1 AS HUGEINT) << length(a)) - 1)"
_LCS = f"length(a) - bit_count(list_reduce(string_split(b, ''), lambda v, c: ((v + {_HIT}) | (v - {_HIT})) & {_FULL}, {_FULL}))"


@query(
    f"""WITH RECURSIVE words AS (SELECT doc_id, {_NAME_WORDS.replace("text, 'ABC", "coalesce(text, ''), 'ABC")} AS w FROM documents),
        named AS (SELECT doc_id, array_to_string(list_slice(w, 1, CASE WHEN doc_id % 2 = 0 THEN 3 ELSE 2 END), ' ') AS name, CASE WHEN doc_id % 7 < 2 THEN w[2] || '.example' END AS domain FROM words WHERE len(w) >= 2),
        known AS (SELECT doc_id AS id, name, domain FROM named WHERE doc_id % 2 = 0), batch AS (SELECT doc_id AS id, name, domain FROM named WHERE doc_id % 2 = 1),
        owned AS (SELECT b.id, min(k.id) AS owner FROM batch b JOIN known k USING (domain) GROUP BY b.id),
        led AS (SELECT b.*, owner, coalesce(min(b.id) OVER (PARTITION BY b.domain), b.id) AS first, CASE WHEN b.domain IS NULL THEN b.id ELSE min(b.id) OVER (PARTITION BY b.domain) END AS leader FROM batch b LEFT JOIN owned USING (id)),
        asked AS (SELECT id, name FROM led WHERE owner IS NULL AND leader = id), held AS (SELECT id, name, 0 AS fresh FROM known UNION ALL SELECT id, name, 1 FROM asked),
        pairs AS (SELECT a.id, h.id AS other, h.fresh, list_sort(list_distinct(string_split(a.name, ' '))) AS x, list_sort(list_distinct(string_split(h.name, ' '))) AS y FROM asked a JOIN held h ON contains(h.name, string_split(a.name, ' ')[1]) AND (h.fresh = 0 OR h.id < a.id)),
        sorted AS (SELECT *, list_sort(list_filter(x, lambda t: list_contains(y, t))) AS met, list_sort(list_filter(x, lambda t: NOT list_contains(y, t))) AS l, list_sort(list_filter(y, lambda t: NOT list_contains(x, t))) AS r FROM pairs),
        texts AS (SELECT *, array_to_string(met, ' ') AS c, array_to_string(list_concat(met, l), ' ') AS a, array_to_string(list_concat(met, r), ' ') AS b FROM sorted),
        scored AS MATERIALIZED (SELECT id, other, fresh, CASE WHEN len(met) > 0 AND (len(l) = 0 OR len(r) = 0) THEN 100.0 ELSE greatest(200.0 * ({_LCS}) / (length(a) + length(b)), CASE WHEN len(met) > 0 THEN 200.0 * length(c) / (length(c) + least(length(a), length(b))) ELSE 0 END) END AS score FROM texts),
        near AS (SELECT id, coalesce(bool_or(fresh = 0), false) AS old, list(other) FILTER (fresh = 1) AS like_new FROM scored WHERE score >= 96 GROUP BY id),
        turns AS (SELECT a.id, row_number() OVER (ORDER BY a.id) AS k, coalesce(old, false) AS old, coalesce(like_new, []) AS like_new FROM asked a LEFT JOIN near USING (id)),
        steps(k, made) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]) UNION ALL SELECT t.k, CASE WHEN t.old OR list_has_any(t.like_new, s.made) THEN s.made ELSE list_append(s.made, t.id) END FROM steps s JOIN turns t ON t.k = s.k + 1),
        made AS (SELECT unnest(made) AS id FROM (SELECT made FROM steps ORDER BY k DESC LIMIT 1)),
        best AS (SELECT id, first(other ORDER BY score DESC, fresh, other) AS other, first(fresh ORDER BY score DESC, fresh, other) AS fresh, max(score) AS score FROM scored WHERE score >= 84 AND (fresh = 0 OR other IN (SELECT id FROM made)) GROUP BY id),
        told AS (SELECT a.id, CASE WHEN score >= 96 THEN other ELSE a.id END AS company, coalesce(score, 0) < 96 AS is_new, coalesce(score, 0) >= 84 AND score < 96 AS needs_review, coalesce(score, 0) AS score FROM asked a LEFT JOIN best USING (id))
        SELECT l.id AS pos, coalesce(l.owner, t.company) AS company, l.owner IS NULL AND l.leader = l.id AND t.is_new AS is_new, l.owner IS NULL AND l.leader = l.id AND coalesce(t.needs_review, false) AS needs_review,
        round(CASE WHEN l.owner IS NULL AND l.leader = l.id THEN t.score ELSE 100 END, 4) AS score FROM led l LEFT JOIN told t ON t.id = l.leader"""
)
def company_resolution(spark, sf_dir):
    """Documents of odd number, as one batch of companies named by their first two words, resolved against those of even number, named by
    three; two in seven have a domain. The company is told by the number of the document that it was made of."""
    letters = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = table(spark, sf_dir, "documents").select("doc_id", F.regexp_extract_all(letters, F.lit("([a-z0-9]+)")).alias("w")).filter(F.size("w") >= 2)
    is_known = F.col("doc_id") % 2 == 0
    domain = F.when(F.col("doc_id") % 7 < 2, F.concat(F.element_at("w", 2), F.lit(".example")))
    named = words.select("doc_id", F.array_join(F.slice("w", 1, F.when(is_known, 3).otherwise(2)), " ").alias("name"), domain.alias("domain"), is_known.alias("is_known"))
    known = named.filter("is_known").select(F.col("doc_id").cast("string").alias("company_id"), F.col("name").alias("canonical_name"), "domain", F.timestamp_seconds("doc_id").alias("first_seen_at"))
    wanted = named.filter("not is_known").select(F.col("doc_id").alias("pos"), "name", F.concat(F.lit("https://"), "domain").alias("website"), F.col("doc_id").cast("string").alias("external_id"), F.lit("").alias("country"))
    found = staged(resolution.resolve(known, wanted), "resolved")
    made = resolution.prepared(wanted).select("pos", "new_id").join(found.filter("is_new").select("pos"), "pos").select(F.col("new_id").alias("company_id"), F.col("pos").alias("made"))
    return found.join(made, "company_id", "left").select("pos", F.coalesce(F.col("made"), F.col("company_id").try_cast("long")).alias("company"), "is_new", "needs_review", F.round("score", 4).alias("score"))


@query()
def normalize_text_nfkc(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(text.normalize_text("text"), 256).alias("digest"))


@query()
def clean_html_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.clean_text(F.col("html")).alias("text"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 3 THEN strftime(o_orderdate, '%Y-%m-%d') || CASE WHEN o_orderkey % 5 = 2 THEN ' 18:45' ELSE ' 00:00' END END AS at FROM orders")
def parse_datetime_mixed(spark, sf_dir):
    """Order dates in three shapes, the order's number as a text, and a text without a date."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey") % 5
    zoned = F.concat(F.date_format(F.date_add("o_orderdate", 1), "EEE, dd MMM yyyy"), F.lit(" 00:30:00 +0545"))
    shown = F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 1, F.date_format("o_orderdate", "dd MMM yyyy")).when(k == 2, zoned).when(k == 3, F.col("o_orderkey").cast("string")).otherwise(F.concat(F.lit("no date "), F.col("o_orderkey").cast("string")))
    return o.select("o_orderkey", F.date_format(dates.parse_datetime(shown), "yyyy-MM-dd HH:mm").alias("at"))


@query()
def token_set_ratio_pairs(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", text.token_set_ratio(F.lower("p_name"), F.lower("p_type")).alias("score"))
