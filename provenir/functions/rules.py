"""Rule tables for postings, and the columns they give.

Texts are expected in normal form (`functions.text.normalize_text`) unless said otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bounded, keywords, western_digits

#: Role families with their keywords; the first that matches wins.
ROLES = {
    "ai_data": ("machine learning", "artificial intelligence", "data scientist", "data engineer", "ml engineer", "nlp", "computer vision", "analytics engineer", "bi engineer"),
    "security": ("cybersecurity", "cyber security", "security engineer", "soc analyst", "penetration tester", "appsec", "infosec"),
    "devops_cloud": ("devops", "site reliability", "sre", "cloud engineer", "platform engineer", "kubernetes", "infrastructure engineer"),
    "quality_assurance": ("quality assurance", "qa engineer", "test engineer", "sdet", "automation tester", "software tester"),
    "it_support": ("it support", "help desk", "helpdesk", "system administrator", "network engineer", "database administrator", "technical support"),
    "product": ("product manager", "product owner", "business analyst", "technical program", "technical project"),
    "technical_design": ("ux designer", "ui designer", "product designer", "ux researcher", "technical writer", "game designer"),
    "technical_management": ("engineering manager", "head of engineering", "cto", "vp engineering", "technical lead", "tech lead"),
    "software_engineering": ("software", "developer", "engineer", "frontend", "front end", "backend", "back end", "fullstack", "full stack", "mobile", "android", "ios", "web3", "blockchain", "embedded", "firmware"),
}

#: Skills with their keywords; all that match count.
SKILLS = {
    "python": ("python",), "javascript": ("javascript", "js"), "typescript": ("typescript", "ts"), "react": ("react", "reactjs", "react.js"),
    "node.js": ("node", "nodejs", "node.js"), "java": ("java",), "c#": ("c#", ".net", "dotnet"), "go": ("golang", "go developer", "go engineer"),
    "rust": ("rust",), "sql": ("sql", "postgres", "postgresql", "mysql", "duckdb"), "aws": ("aws", "amazon web services"), "azure": ("azure",),
    "gcp": ("gcp", "google cloud"), "docker": ("docker",), "kubernetes": ("kubernetes", "k8s"), "pytorch": ("pytorch",), "tensorflow": ("tensorflow",),
    "llm": ("large language model", "llm", "generative ai"),
}

#: Seniority levels with their keywords; the first that matches wins.
SENIORITY = {
    "intern": ("intern", "internship", "trainee"),
    "entry": ("entry level", "entry-level", "new grad", "graduate", "junior", "associate"),
    "executive": ("chief technology", "cto", "vice president", "vp engineering", "head of"),
    "lead": ("principal", "staff", "lead", "architect"),
    "senior": ("senior", "sr.", "sr "),
    "mid": ("mid level", "mid-level", "intermediate"),
}

#: Employment types with the substrings that name them, in order.
EMPLOYMENT = {
    "full_time": ("full time", "full-time", "full_time", "permanent"),
    "part_time": ("part time", "part-time", "part_time"),
    "contract": ("contract", "contractor", "temporary"),
    "internship": ("intern", "internship", "trainee"),
    "freelance": ("freelance",),
}

#: Patterns of workplace and eligibility; a list's first match is the evidence.
WORKPLACE = {
    "hybrid": r"\bhybrid\b",
    "remote": r"\bremote|work from (?:home|anywhere)|distributed\b",
    "onsite": r"\bon[ -]?site|in office\b",
}
INELIGIBLE = (
    r"\b(?:us|u\.s\.|united states) only\b",
    r"\bmust (?:be|reside|live) in (?:the )?(?:us|united states|canada|uk|united kingdom|eu|european union)\b",
    r"\bremote (?:within|in) (?:the )?(?:us|united states|canada|uk|united kingdom)\b",
    r"\b(?:us|canada|uk|eu) residents? only\b",
    r"\bnot available in nepal\b",
)
ELIGIBLE = (r"\bnepal\b", r"\bworldwide\b", r"\banywhere in the world\b", r"\bwork from anywhere\b", r"\bglobal remote\b", r"\basia(?:[- ]pacific| pacific)?\b", r"\bsouth asia\b")
LIKELY = (r"\banywhere\b", r"\bremote\b", r"\bdistributed team\b", r"\basynchronous\b", r"\bcontractor\b")
#: What is told of each outcome, the version of the rules, and the evidence of none.
EXPLANATIONS = {
    "restricted": "The posting explicitly restricts applicants to a region that excludes Nepal.",
    "named": "The posting explicitly names Nepal or a geography that includes Nepal.",
    "onsite": "The role is onsite outside the Nepal-relevant employer track.",
    "likely": "The posting is remote but does not state a country restriction that excludes Nepal.",
    "unknown": "The posting does not provide enough geographic evidence to determine Nepal eligibility.",
}
RULE_VERSION = "eligibility-v1"
NO_EVIDENCE = "No geographic evidence"

#: Priority of sources when two report the same posting.
PRIORITY = {100: ("greenhouse", "lever", "ashby"), 50: ("himalayas", "remoteok", "remotive")}
CURRENCIES = ("USD", "NPR", "EUR", "GBP", "INR", "AUD", "CAD")
SYMBOLS = {"$": "USD", "€": "EUR", "£": "GBP"}

#: Forms in which experience is asked for, first to last, with the groups of the least and the most years.
_NUMBER = r"(\d+(?:\.\d+)?)"
EXPERIENCE = (
    (rf"{_NUMBER}\s*(?:-|–|to)\s*{_NUMBER}\+?\s*years?", 1, 2),
    (rf"(?:minimum|min\.?|at least)\s*{_NUMBER}\+?\s*years?", 1, None),
    (rf"{_NUMBER}\+\s*years?", 1, None),
    (rf"{_NUMBER}\s*years? (?:of )?experience", 1, 1),
)


def _first(text: Column, rules: dict[str, str], otherwise: Column) -> Column:
    """Name of the first rule whose pattern is found."""
    found = None
    for name, pattern in rules.items():
        found = (F if found is None else found).when(text.rlike(pattern), F.lit(name))
    return found.otherwise(otherwise)


def classify_role(text: Column) -> Column:
    return _first(text, {k: keywords(v) for k, v in ROLES.items()}, F.lit("other"))


def classify_seniority(text: Column) -> Column:
    return _first(text, {k: keywords(v) for k, v in SENIORITY.items()}, F.lit("unspecified"))


def extract_skills(text: Column, supplied: Column | None = None) -> Column:
    """Sorted skills named in the text, with those supplied (in normal form)."""
    found = F.array_compact(F.array(*(F.when(text.rlike(keywords(v)), F.lit(k)) for k, v in SKILLS.items())))
    return F.array_sort(found if supplied is None else F.array_union(found, F.coalesce(supplied, F.array().cast("array<string>"))))


def infer_workplace(text: Column) -> Column:
    return _first(text, {k: bounded(v) for k, v in WORKPLACE.items()}, F.lit("unknown"))


def employment_type(text: Column) -> Column:
    found = _first(text, {k: "|".join(v) for k, v in EMPLOYMENT.items()}, F.left(text, F.lit(50)))
    return F.when(text != "", found)


def extract_experience(text: Column) -> Column:
    """struct(min, max) of years asked for: a range, else a minimum, else N+, else N years of experience."""
    t = western_digits(F.coalesce(text, F.lit("")))
    found = None
    for pattern, low, high in EXPERIENCE:
        value = lambda k, p=pattern: F.regexp_extract(t, p, k).try_cast("double") if k else F.lit(None).cast("double")
        both = F.struct(value(low).alias("min"), value(high).alias("max"))
        found = F.when(t.rlike(pattern), both) if found is None else found.when(t.rlike(pattern), both)
    none = F.struct(F.lit(None).cast("double").alias("min"), F.lit(None).cast("double").alias("max"))
    return found.otherwise(none)


def parse_salary(raw: Column, compatible: bool = True) -> Column:
    """struct(min, max, currency, period) from a raw text.

    `compatible` keeps the published reading in which "annual" counts as hourly; without it, it is yearly.
    """
    t = western_digits(F.replace(F.coalesce(raw, F.lit("")), F.lit(","), F.lit("")))
    code = rf"(?i)(?<![\p{{L}}\p{{N}}_])({'|'.join(CURRENCIES)})(?![\p{{L}}\p{{N}}_])|([$€£])"
    symbol = F.regexp_extract(t, code, 2)
    currency = F.when(F.regexp_extract(t, code, 1) != "", F.upper(F.regexp_extract(t, code, 1)))
    for sign, name in SYMBOLS.items():
        currency = currency.when(symbol == sign, F.lit(name))
    amounts = F.transform(
        F.regexp_extract_all(t, F.lit(r"\d+(?:\.\d+)?(?U)[\s\x1c-\x1f]*[kK]?"), F.lit(0)),
        lambda m: F.regexp_extract(m, r"^(\d+(?:\.\d+)?)", 1).try_cast("double") * F.when(m.rlike("[kK]$"), 1000).otherwise(1),
    )
    per = lambda unit: t.rlike(rf"(?i)(?:/|per(?U)[\s\x1c-\x1f]+){unit}")
    annual = t.rlike("(?i)annual")
    hourly = per("hour") | annual if compatible else per("hour")
    yearly = per("year") if compatible else per("year") | annual
    period = F.when(hourly, F.lit("hour")).when(per("month"), F.lit("month")).when(yearly, F.lit("year"))
    return F.struct(F.try_element_at(amounts, F.lit(1)).alias("min"), F.try_element_at(amounts, F.lit(2)).alias("max"), currency.alias("currency"), period.alias("period"))


def evidence_text(candidate_location: Column, location: Column, description: Column) -> Column:
    """What eligibility is read from: the filled ones of the three, cut to 1000 characters (before normal form)."""
    return F.left(F.concat_ws(" | ", *(F.nullif(c, F.lit("")) for c in (candidate_location, location, description))), F.lit(1000))


def eligibility(evidence: Column, workplace: Column, candidate_location: Column, location: Column) -> Column:
    """struct(status, confidence, evidence, explanation) from `evidence` in normal form."""

    def match(patterns: tuple[str, ...]) -> Column:
        return F.coalesce(*(F.regexp_substr(evidence, F.lit(bounded(p))) for p in patterns))

    def verdict(status: str, confidence: float, found: Column, why: str) -> Column:
        return F.struct(F.lit(status).alias("status"), F.lit(confidence).alias("confidence"), found.alias("evidence"), F.lit(EXPLANATIONS[why]).alias("explanation"))

    place = F.coalesce(F.nullif(location, F.lit("")), F.lit("onsite"))
    rest = F.left(F.coalesce(F.nullif(candidate_location, F.lit("")), F.nullif(location, F.lit("")), F.lit(NO_EVIDENCE)), F.lit(300))
    return (
        F.when(match(INELIGIBLE).isNotNull(), verdict("ineligible", 0.98, match(INELIGIBLE), "restricted"))
        .when(match(ELIGIBLE).isNotNull(), verdict("eligible", 0.95, match(ELIGIBLE), "named"))
        .when(workplace == "onsite", verdict("ineligible", 0.9, place, "onsite"))
        .when(match(LIKELY).isNotNull(), verdict("likely", 0.65, match(LIKELY), "likely"))
        .otherwise(verdict("unknown", 0.35, rest, "unknown"))
    )


def is_early_career(seniority: Column, least_years: Column) -> Column:
    return seniority.isin("intern", "entry") | F.coalesce(least_years <= 2, F.lit(False))


def source_priority(source_id: Column) -> Column:
    found = None
    for value, names in PRIORITY.items():
        found = (F if found is None else found).when(source_id.isin(*names), F.lit(value))
    return found.otherwise(F.lit(75))


def organization_email(email: Column, domain: Column) -> Column:
    """An address of an organisation, of its own domain where that is known; null for personal ones."""
    folded = F.lower(F.regexp_replace(email, r"^(?U)[\s\x1c-\x1f]+|(?U)[\s\x1c-\x1f]+$", ""))
    local, host = F.regexp_extract(folded, r"(?s)^(.*)@[^@]*$", 1), F.regexp_extract(folded, r"@([^@]*)$", 1)
    personal = local.rlike("recruiter|firstname|lastname")
    known = F.nullif(domain, F.lit(""))
    own = known.isNull() | (host == known) | host.endswith(F.concat(F.lit("."), known))
    return F.when(email.contains("@") & ~personal & own, F.concat(local, F.lit("@"), host))
