import datetime

import pytest
from pyspark.sql import functions as F

from provenir.functions import dates, ids, rules, text, urls


def one(spark, value, column, name="x", kind="string"):
    return spark.createDataFrame([(value,)], f"{name} {kind}").select(column.alias("y")).first()["y"]


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("HTTPS://Example.COM:443/jobs//1/?utm_source=x&b=2&a=1#top", "https://example.com/jobs/1?a=1&b=2"),
        ("http://user:pw@Example.org:8080", "http://example.org:8080/"),
        ("http://münchen.de/ä?q=a+b&e=", "http://xn--mnchen-3ya.de/ä?e=&q=a+b"),
        ("https://x.org/?Ref=1&UTM_x=2&t=%7E*%zz", "https://x.org/?t=~%2A%25zz"),
        ("ftp://example.com/", None), ("https://", None), ("", None), (None, None),
    ],
)
def test_canonical_url(spark, given, wanted):
    assert one(spark, given, urls.canonical_url(F.col("x"))) == wanted


def test_domain(spark):
    assert one(spark, "https://www.Example.com:80/a", urls.domain_of(urls.canonical_url(F.col("x")))) == "example.com"


@pytest.mark.parametrize("url, good", [("https://x.org/a", True), ("file:///etc", False), ("https://u:p@x.org/", False), ("ftp://x.org", False), (None, False)])
def test_public_syntax(spark, url, good):
    assert one(spark, url, urls.syntactically_public(F.col("x"))) is good


def test_normal_form(spark):
    values = ["  नेपाल   काम ", "Straße ﬁne", None, "", "A\x1cB C"]
    frame = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r["y"] for r in frame.select(text.normalize_text("x").alias("y")).collect()]
    assert got == ["नेपाल काम", "strasse fine", "", "", "a b c"]
    ascii_only = spark.createDataFrame([(" A\t b ",), (None,)], "x string").select(text.normalize_ascii(F.col("x")).alias("y")).collect()
    assert [r["y"] for r in ascii_only] == ["a b", ""]


def test_stable_id(spark):
    import uuid

    key = lambda v: one(spark, v, ids.stable_id("company", text.normalize_text("x")))
    assert key("Example") == key(" example ") == "5dab1b12-7fe5-5edf-8b9f-66d1184b3694" == str(uuid.uuid5(uuid.UUID(ids.NAMESPACE), "company|example"))


def test_clean_text(spark):
    assert one(spark, "<p>A &amp; B</p><b>c</b>", text.clean_text(F.col("x"), 5)) == "A & B"
    assert one(spark, " \n ", text.clean_text(F.col("x"))) is None


DATES = {
    "2026-08-20T10:00:00Z": "2026-08-20 10:00:00.000000", "2026-08-20": "2026-08-20 00:00:00.000000", "2026-08-20 10:05": "2026-08-20 10:05:00.000000", "2026-08-20T10:00:00.123456+05:45": "2026-08-20 04:15:00.123456",
    "20 Aug 2026 10:00 +0545": "2026-08-20 04:15:00.000000", "August 20th, 2026 10:30": "2026-08-20 10:30:00.000000", "Thu, 20 Aug 2026 12:00:10 GMT": "2026-08-20 12:00:10.000000", "2026/8/2": "2026-08-02 00:00:00.000000",
    "8/9/2026": "2026-08-09 00:00:00.000000", "20/8/2026": "2026-08-20 00:00:00.000000", "3-Mar-2026": "2026-03-03 00:00:00.000000", "Sept 3 2026": "2026-09-03 00:00:00.000000",
    # by the parser
    "20 August 2026 5pm": "2026-08-20 17:00:00.000000", "20260820": "2026-08-20 00:00:00.000000", "May 2026": "2026-05-01 00:00:00.000000", "12.05.2026": "2026-12-05 00:00:00.000000",
    # no instant, or one that only today could complete
    "7": None, "2026": None, "202608": None, "1700000000": None, "1700000000000": None, "10:30": None, "Monday": None, "2026-02-30": None, "2026-08-20T25:00:00Z": None, "soon": None, "no date 12": None, "": None, " ": None, "x" * 5000: None,
}


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kathmandu"])
def test_dates(spark, zone):
    rows = spark.createDataFrame([(t,) for t in [*DATES, None]], "x string")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = {r["x"]: r["at"] for r in rows.select("x", F.unix_micros(dates.parse_datetime(F.col("x"))).alias("at")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    shown = {t: at and (datetime.datetime(1970, 1, 1) + datetime.timedelta(microseconds=at)).strftime("%Y-%m-%d %H:%M:%S.%f") for t, at in got.items()}
    assert shown == DATES | {None: None}


def test_tiers_agree():
    assert {t: at.strftime("%Y-%m-%d %H:%M:%S.%f") if (at := dates.read_date(t)) else None for t in DATES if DATES[t]} == {t: v for t, v in DATES.items() if v}


@pytest.mark.parametrize(
    "given, wanted",
    [("machine learning engineer", "ai_data"), ("sre", "devops_cloud"), ("desire", "other"), ("ios", "software_engineering"), ("cook", "other")],
)
def test_roles(spark, given, wanted):
    assert one(spark, given, rules.classify_role(F.col("x"))) == wanted


def test_skills(spark):
    assert one(spark, "python engineer use aws, docker and postgresql", rules.extract_skills(F.col("x"))) == ["aws", "docker", "python", "sql"]
    assert one(spark, "node.js, c# and .net", rules.extract_skills(F.col("x"), F.array(F.lit("extra")))) == ["c#", "extra", "javascript", "node.js"]


@pytest.mark.parametrize("given, wanted", [("junior software developer", "entry"), ("sr. engineer", "senior"), ("cto", "executive"), ("worker", "unspecified")])
def test_seniority(spark, given, wanted):
    assert one(spark, given, rules.classify_seniority(F.col("x"))) == wanted


@pytest.mark.parametrize(
    "given, wanted",
    [("requires 1-2 years experience", (1.0, 2.0)), ("at least 3 years", (3.0, None)), ("5+ years", (5.0, None)), ("4 years of experience", (4.0, 4.0)), ("२ to ४ years", (2.0, 4.0)), ("none", (None, None)), (None, (None, None))],
)
def test_experience(spark, given, wanted):
    assert tuple(one(spark, given, rules.extract_experience(F.col("x")))) == wanted


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("USD 40k - 60k per year", (40000.0, 60000.0, "USD", "year")), ("€50,000 annual", (50000.0, None, "EUR", "hour")), ("£20/hour", (20.0, None, "GBP", "hour")),
        ("npr 100000 per month", (100000.0, None, "NPR", "month")), ("", (None, None, None, None)), (None, (None, None, None, None)),
    ],
)
def test_salary(spark, given, wanted):
    assert tuple(one(spark, given, rules.parse_salary(F.col("x")))) == wanted


def test_salary_fixed_period(spark):
    assert one(spark, "$5 annual", rules.parse_salary(F.col("x"), compatible=False))["period"] == "year"


@pytest.mark.parametrize(
    "workplace, candidate, place, body, status, confidence, found",
    [
        ("remote", "US only", "Remote", "Distributed team", "ineligible", 0.98, "us only"), ("remote", "Worldwide", None, "", "eligible", 0.95, "worldwide"),
        ("remote", "Remote", None, "", "likely", 0.65, "remote"), ("onsite", None, "Berlin", "", "ineligible", 0.9, "Berlin"), ("unknown", None, None, None, "unknown", 0.35, "No geographic evidence"),
        ("remote", None, None, "Asia-Pacific remote", "eligible", 0.95, "asia-pacific"),
    ],
)
def test_eligibility(spark, workplace, candidate, place, body, status, confidence, found):
    row = spark.createDataFrame([(workplace, candidate, place, body)], "w string, c string, l string, d string")
    evidence = text.normalize_text(rules.evidence_text(F.col("c"), F.col("l"), F.col("d")))
    got = row.withColumn("e", evidence).select(rules.eligibility(F.col("e"), F.col("w"), F.col("c"), F.col("l")).alias("v")).first()["v"]
    assert (got["status"], got["confidence"], got["evidence"]) == (status, confidence, found)


@pytest.mark.parametrize("given, wanted", [("work remotely", "remote"), ("hybrid remote", "hybrid"), ("on-site", "onsite"), ("x", "unknown")])
def test_workplace(spark, given, wanted):
    assert one(spark, given, rules.infer_workplace(F.col("x"))) == wanted


@pytest.mark.parametrize("given, wanted", [("full time", "full_time"), ("internal", "internship"), ("odd", "odd"), ("", None)])
def test_employment(spark, given, wanted):
    assert one(spark, given, rules.employment_type(F.col("x"))) == wanted


@pytest.mark.parametrize(
    "email, domain, wanted",
    [(" Jobs@Example.com ", "example.com", "jobs@example.com"), ("a@hr.example.com", "example.com", "a@hr.example.com"), ("a@other.com", "example.com", None), ("recruiter1@x.org", None, None), ("none", None, None), (None, None, None)],
)
def test_organization_email(spark, email, domain, wanted):
    row = spark.createDataFrame([(email, domain)], "e string, d string")
    assert row.select(rules.organization_email(F.col("e"), F.col("d")).alias("y")).first()["y"] == wanted


def test_priority_and_early_career(spark):
    rows = spark.createDataFrame([("lever", "entry", None), ("own", "senior", 2.0), ("remotive", "mid", 3.0)], "s string, k string, y double")
    got = rows.select(rules.source_priority(F.col("s")).alias("p"), rules.is_early_career(F.col("k"), F.col("y")).alias("e")).collect()
    assert [(r["p"], r["e"]) for r in got] == [(100, True), (75, True), (50, False)]


def test_token_set():
    assert text.token_set_similarity("example", "example labs") == 100
    assert round(text.token_set_similarity("kathmandu software solutions", "kathmandu software solution pvt ltd"), 2) >= 84
    assert text.token_set_similarity("", "x") == 0 and text.token_set_similarity("abc", "xyz") == 0


def test_weekly_run_id(spark):
    import datetime
    import uuid

    day = one(spark, "2027-01-01", ids.weekly_run_id(F.lit("remoteok"), F.to_date("x")))
    year, week, _ = datetime.date(2027, 1, 1).isocalendar()
    assert day == str(uuid.uuid5(uuid.UUID(ids.NAMESPACE), f"run|remoteok|{year}|{week}"))
