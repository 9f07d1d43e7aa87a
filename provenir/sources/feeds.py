"""Connectors: JSON, CSV and HTML payloads to candidates, as projections over fetched documents.

Each function takes `documents` (seq long, the order of
fetching, url string, content binary or string, observed_at timestamp) and the source, and gives
candidates with pos, their order in the batch. JSON is read schema-first with from_json; fields of more than one shape
are read as variants.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.dates import parse_datetime
from ..functions.text import first_truthy, normalize_text
from ..schemas import COMPANY_CANDIDATE, JOB_CANDIDATE, LEAD
from .catalog import Source


@dataclass
class Batch:
    """What one source gave."""

    jobs: DataFrame | None = None
    companies: DataFrame | None = None
    leads: DataFrame | None = None
    full_snapshot: bool = True
    documents: DataFrame | None = field(default=None)


def _text(documents: DataFrame) -> Column:
    """JSON text; a byte-order mark is dropped."""
    return F.regexp_replace(F.col("content").cast("string"), "^﻿", "")


def _items(documents: DataFrame, schema: str, path: Callable[[Column], Column]) -> DataFrame:
    """One row an element of the array that `path` finds in each document."""
    parsed = documents.select("seq", "url", "observed_at", F.from_json(_text(documents), schema, {"mode": "FAILFAST"}).alias("body"))
    return parsed.select("seq", "url", "observed_at", F.posexplode(path(F.col("body"))).alias("at", "row"))


def _shaped(rows: DataFrame, schema: str, columns: dict[str, Column]) -> DataFrame:
    """`columns` cast to `schema`, the others null, with pos in order of document (seq) and element (at)."""
    made = []
    for part in schema.split(", "):
        name, kind = part.split(" ", 1)
        made.append(columns.get(name, F.lit(None)).cast(kind).alias(name))
    pos = F.shiftleft(F.col("seq"), 32) + F.col("at") if "at" in rows.columns else F.monotonically_increasing_id()
    return rows.select(pos.alias("pos"), *made)


def _common(source: Source, public: bool = True) -> dict[str, Column]:
    return {
        "source_id": F.lit(source.id), "observed_at": F.col("observed_at"), "explicitly_closed": F.lit(False),
        "description_public": F.lit(public and source.redistribution == "attributed"), "attribution": F.lit(source.attribution if public else None),
    }


def _workplace(*parts: Column) -> Column:
    return rules.infer_workplace(normalize_text(F.concat_ws(" ", *(F.coalesce(p, F.lit("")) for p in parts))))


def remoteok(documents: DataFrame, source: Source) -> Batch:
    """An array whose first element may be a notice; rows without position or company are skipped."""
    item = "struct<legal:string,id:string,slug:string,position:string,company:string,location:string,description:string,url:string,apply_url:string,tags:array<string>,date:string,epoch:string,salary:string,job_type:string>"
    rows = _items(documents, f"array<{item}>", lambda b: b).filter(~((F.col("at") == 0) & F.col("row.legal").isNotNull()))
    r = lambda n: F.col(f"row.{n}")
    kept = rows.filter(first_truthy(r("position")).isNotNull() & first_truthy(r("company")).isNotNull())
    place = F.coalesce(first_truthy(r("location")), F.lit("Worldwide"))
    return Batch(jobs=_shaped(kept, JOB_CANDIDATE, _common(source) | {
        "source_url": F.coalesce(first_truthy(r("url")), F.col("url")), "external_id": F.coalesce(first_truthy(r("id"), r("slug")), F.lit("")), "company_name": r("company"), "title": r("position"),
        "description": r("description"), "apply_url": first_truthy(r("apply_url"), r("url")), "location_text": place, "candidate_location": place, "employment_type": r("job_type"),
        "workplace_type": F.lit("remote"), "salary_text": r("salary"), "skills": F.coalesce(r("tags"), F.array().cast("array<string>")), "posted_at": parse_datetime(first_truthy(r("date"), r("epoch"))),
    }))


def remotive(documents: DataFrame, source: Source) -> Batch:
    """`jobs`; rows without title, company or URL are skipped."""
    item = "struct<id:string,url:string,title:string,company_name:string,category:string,job_type:string,publication_date:string,candidate_required_location:string,salary:string,description:string>"
    rows = _items(documents, f"struct<jobs:array<{item}>>", lambda b: b["jobs"])
    r = lambda n: F.col(f"row.{n}")
    kept = rows.filter(F.greatest(*(first_truthy(r(n)).isNull().cast("int") for n in ("title", "company_name", "url"))) == 0)
    place = r("candidate_required_location")
    return Batch(jobs=_shaped(kept, JOB_CANDIDATE, _common(source) | {
        "source_url": r("url"), "external_id": r("id"), "company_name": r("company_name"), "title": r("title"), "description": r("description"), "apply_url": r("url"), "location_text": place,
        "candidate_location": place, "employment_type": r("job_type"), "workplace_type": F.lit("remote"), "salary_text": r("salary"),
        "skills": F.when(first_truthy(r("category")).isNotNull(), F.array(r("category"))).otherwise(F.array().cast("array<string>")), "posted_at": parse_datetime(r("publication_date")),
    }))


def himalayas(documents: DataFrame, source: Source) -> Batch:
    """Pages of `jobs` or `data`; location and company come in more than one shape."""
    parsed = documents.select("seq", "url", "observed_at", F.parse_json(_text(documents)).alias("body"))
    listed = F.coalesce(*(F.try_variant_get("body", f"$.{k}", "array<variant>") for k in ("jobs", "data")))
    rows = parsed.select("seq", "url", "observed_at", F.posexplode(listed).alias("at", "row"))
    r = lambda n: F.try_variant_get("row", f"$.{n}", "string")
    listed_place = F.array_join(F.try_variant_get("row", "$.locationRestrictions", "array<string>"), ", ")
    place = first_truthy(listed_place, F.when(listed_place.isNull(), r("locationRestrictions")), r("location"), r("country"))
    company = F.coalesce(first_truthy(r("companyName")), F.try_variant_get("row", "$.company.name", "string"), r("company"))
    made = rows.withColumn("_title", F.when(first_truthy(r("title")).isNull(), F.raise_error("a posting has no title")).otherwise(r("title")))
    return Batch(jobs=_shaped(made, JOB_CANDIDATE, _common(source) | {
        "source_url": first_truthy(r("url"), r("applicationLink")), "external_id": F.coalesce(first_truthy(r("guid"), r("id")), F.lit("")), "company_name": company,
        "company_website": F.try_variant_get("row", "$.company.website", "string"), "title": F.col("_title"), "description": r("description"), "apply_url": first_truthy(r("applicationLink"), r("url")),
        "location_text": place, "candidate_location": place, "employment_type": r("employmentType"), "workplace_type": _workplace(F.lit("remote"), place), "salary_text": r("salaryDescription"),
        "skills": F.coalesce(F.try_variant_get("row", "$.categories", "array<string>"), F.array().cast("array<string>")), "posted_at": parse_datetime(r("pubDate")), "expires_at": parse_datetime(r("expiryDate")),
    }))


def next_cursor(content: str) -> str | None:
    import json

    return json.loads(content.lstrip("﻿")).get("nextCursor") or None


def _boards(source: Source) -> list[dict]:
    return [b if isinstance(b, dict) else {"token": b} for b in source.parameter("boards")]


#: The path part before the token in the addresses of the boards' interfaces.
_BEFORE_TOKEN = "boards|postings|job-board"


def _board_columns(documents: DataFrame, source: Source) -> DataFrame:
    """`documents` with board (token), company and website of the board that the URL asks for."""
    boards = documents.sparkSession.createDataFrame([(b["token"], b.get("company") or b["token"], b.get("website")) for b in _boards(source)], "board string, company string, website string")
    token = F.url_decode(F.regexp_extract("url", f"^[^?#]*?/(?:{_BEFORE_TOKEN})/([^/?#]+)", 1))
    return documents.withColumn("board", token).join(boards, "board")


def _ats(documents: DataFrame, source: Source, schema: str, path, columns: Callable) -> Batch:
    placed = _board_columns(documents, source)
    parsed = placed.select("seq", "url", "observed_at", "company", "website", F.from_json(_text(documents), schema, {"mode": "FAILFAST"}).alias("body"))
    rows = parsed.select("seq", "url", "observed_at", "company", "website", F.posexplode(path(F.col("body"))).alias("at", "row"))
    jobs = _shaped(rows, JOB_CANDIDATE, _common(source, public=False) | {"company_name": F.col("company"), "company_website": F.col("website")} | columns(lambda n: F.col(f"row.{n}")))
    firms = _shaped(placed.withColumn("at", F.lit(0)), COMPANY_CANDIDATE, {
        "source_id": F.lit(source.id), "source_url": F.col("url"), "external_id": F.col("board"), "name": F.col("company"), "website": F.col("website"), "careers_url": F.col("url"),
        "aliases": F.array(), "sectors": F.array(F.lit("technology")), "nepal_relationship": F.lit("unknown"), "confidence": F.lit(0.85), "observed_at": F.col("observed_at"),
    })
    return Batch(jobs=jobs, companies=firms)


def greenhouse(documents: DataFrame, source: Source) -> Batch:
    item = "struct<id:string,absolute_url:string,title:string,content:string,location:struct<name:string>,updated_at:string>"
    return _ats(documents, source, f"struct<jobs:array<{item}>>", lambda b: b["jobs"], lambda r: {
        "source_url": F.coalesce(first_truthy(r("absolute_url")), F.col("url")), "external_id": r("id"), "title": r("title"), "description": r("content"), "apply_url": r("absolute_url"),
        "location_text": r("location.name"), "candidate_location": r("location.name"), "workplace_type": _workplace(r("title"), r("location.name"), r("content")), "posted_at": parse_datetime(r("updated_at")),
    })


def lever(documents: DataFrame, source: Source) -> Batch:
    item = "struct<id:string,text:string,description:string,additional:string,hostedUrl:string,applyUrl:string,categories:struct<location:string,commitment:string>,createdAt:string>"
    whole = lambda r: F.concat_ws(" ", first_truthy(r("description")), first_truthy(r("additional")))
    return _ats(documents, source, f"array<{item}>", lambda b: b, lambda r: {
        "source_url": F.coalesce(first_truthy(r("hostedUrl"), r("applyUrl")), F.col("url")), "external_id": r("id"), "title": r("text"), "description": whole(r), "apply_url": first_truthy(r("applyUrl"), r("hostedUrl")),
        "location_text": r("categories.location"), "candidate_location": r("categories.location"), "employment_type": r("categories.commitment"),
        "workplace_type": _workplace(r("text"), r("categories.location"), r("description")), "posted_at": parse_datetime(r("createdAt")),
    })


def ashby(documents: DataFrame, source: Source) -> Batch:
    item = "struct<id:string,title:string,location:string,jobUrl:string,applyUrl:string,descriptionHtml:string,descriptionPlain:string,employmentType:string,workplaceType:string,publishedAt:string>"
    return _ats(documents, source, f"struct<jobs:array<{item}>>", lambda b: b["jobs"], lambda r: {
        "source_url": F.coalesce(first_truthy(r("jobUrl"), r("applyUrl")), F.col("url")), "external_id": first_truthy(r("id"), r("jobUrl")), "title": r("title"),
        "description": first_truthy(r("descriptionHtml"), r("descriptionPlain")), "apply_url": first_truthy(r("applyUrl"), r("jobUrl")), "location_text": r("location"), "candidate_location": r("location"),
        "employment_type": r("employmentType"), "workplace_type": _workplace(r("title"), r("location"), r("workplaceType")), "posted_at": parse_datetime(r("publishedAt")),
    })


def brave_search(documents: DataFrame, source: Source) -> Batch:
    """Web results as leads; never a full snapshot."""
    rows = _items(documents, "struct<web:struct<results:array<struct<url:string,title:string,description:string>>>>", lambda b: b["web"]["results"])
    return Batch(full_snapshot=False, leads=_shaped(rows, LEAD, {
        "source_id": F.lit(source.id), "source_url": F.col("row.url"), "external_id": F.col("row.url"), "title": F.col("row.title"), "payload": F.to_json("row"), "observed_at": F.col("observed_at"),
    }))


def google_places(documents: DataFrame, source: Source) -> Batch:
    """Place ids as leads; nothing else of a place is kept."""
    rows = _items(documents, "struct<places:array<struct<id:string>>>", lambda b: b["places"]).filter("row.id is not null and row.id <> ''")
    return Batch(full_snapshot=False, leads=_shaped(rows, LEAD, {
        "source_id": F.lit(source.id), "source_url": F.col("url"), "external_id": F.col("row.id"), "payload": F.to_json("row"), "observed_at": F.col("observed_at"),
    }))


MANUAL = "name string, legal_name string, registration_id string, website string, careers_url string, sectors string, country string, locality string, address string, nepal_relationship string, email string, phone string, profile string, confidence string, source_url string"


def manual_csv(rows: DataFrame, source: Source) -> Batch:
    """Companies of a CSV with a header (`read_manual_csv`); rows without a name are skipped."""
    kept = rows.filter(F.trim("name") != "").withColumn("observed_at", F.current_timestamp())
    or_else = lambda c, d: F.coalesce(first_truthy(F.trim(c)), F.lit(d))
    parts = F.filter(F.transform(F.split(or_else("sectors", "technology"), r"\|"), F.trim), lambda s: s != "")
    return Batch(companies=_shaped(kept, COMPANY_CANDIDATE, {
        "source_id": F.lit(source.id), "source_url": F.coalesce(first_truthy(F.col("source_url")), F.lit(source.base_url or "manual")), "external_id": first_truthy(F.col("registration_id")), "name": F.trim("name"),
        "legal_name": F.col("legal_name"), "aliases": F.array(), "website": F.col("website"), "careers_url": F.col("careers_url"), "sectors": parts, "nepal_relationship": or_else("nepal_relationship", "based"),
        "country": or_else("country", "Nepal"), "locality": F.col("locality"), "address": F.col("address"), "official_email": F.col("email"), "official_phone": F.col("phone"), "profile": F.col("profile"),
        "confidence": F.coalesce(F.col("confidence").try_cast("double"), F.lit(0.9)), "observed_at": F.col("observed_at"),
    }))


def read_manual_csv(spark, path: str) -> DataFrame:
    """A CSV with header, columns by name; a byte-order mark and missing columns are tolerated."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    raw = raw.toDF(*(c.lstrip("﻿").strip() for c in raw.columns))
    return raw.select(*((F.col(n) if n in raw.columns else F.lit(None)).cast("string").alias(n) for n in (p.split()[0] for p in MANUAL.split(", "))))


class _Selector(HTMLParser):
    """Elements that match `tag`, `.class`, `tag.class` or `#id`, with their text, attributes and inner elements."""

    VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = {"tag": "", "attrs": {}, "kids": [], "text": [], "up": None}
        self._at = self.root

    def handle_starttag(self, tag, attrs):
        node = {"tag": tag, "attrs": dict(attrs), "kids": [], "text": [], "up": self._at}
        self._at["kids"].append(node)
        if tag not in self.VOID:
            self._at = node

    def handle_endtag(self, tag):
        node = self._at
        while node is not self.root and node["tag"] != tag:
            node = node["up"]
        if node is not self.root:
            self._at = node["up"]

    def handle_data(self, data):
        self._at["text"].append(data)
        self._at["kids"].append(data)


def _walk(node) -> Iterator[dict]:
    for kid in node["kids"]:
        if isinstance(kid, dict):
            yield kid
            yield from _walk(kid)


def _fits(node: dict, selector: str) -> bool:
    head, _, ident = selector.partition("#")
    tag, *classes = head.split(".")
    return (not tag or node["tag"] == tag) and (not ident or node["attrs"].get("id") == ident) and set(classes) <= set((node["attrs"].get("class") or "").split())


def select_all(node: dict, selector: str) -> list[dict]:
    """Elements below `node` that a selector of descendants names, in order."""
    found = [node]
    for part in selector.split():
        found = list({id(k): k for n in found for k in _walk(n) if _fits(k, part)}.values())
    return found


def inner_text(node: dict) -> str:
    return " ".join(" ".join(k if isinstance(k, str) else inner_text(k) for k in node["kids"]).split())


def html_directory(documents: DataFrame, source: Source) -> Batch:
    """Companies of directory pages, by the selectors item, name, website, profile and location."""
    rules_ = {k: source.parameters.get(k) for k in ("item_selector", "name_selector", "website_selector", "profile_selector", "location_selector")}
    source.parameter("item_selector")

    def parse(frames):
        import pandas as pd

        for frame in frames:
            rows = []
            for seq, url, content, seen in zip(frame["seq"], frame["url"], frame["content"], frame["observed_at"]):
                page = _Selector()
                page.feed(bytes(content).decode("utf-8", "replace") if not isinstance(content, str) else content)
                for at, item in enumerate(select_all(page.root, rules_["item_selector"])):
                    pick = lambda k: next(iter(select_all(item, rules_[k])), None) if rules_[k] else None  # noqa: B023, E731
                    name, site = pick("name_selector") or item, pick("website_selector")
                    text = lambda n: inner_text(n) if n else None
                    if inner_text(name):
                        rows.append((seq, url, seen, at, inner_text(name), site["attrs"].get("href") if site else None, text(pick("profile_selector")), text(pick("location_selector"))))
            yield pd.DataFrame(rows, columns=["seq", "url", "observed_at", "at", "name", "website", "profile", "locality"])

    rows = documents.select("seq", "url", "content", "observed_at").mapInPandas(parse, "seq long, url string, observed_at timestamp, at int, name string, website string, profile string, locality string")
    return Batch(companies=_shaped(rows, COMPANY_CANDIDATE, {
        "source_id": F.lit(source.id), "source_url": F.col("url"), "name": F.col("name"), "aliases": F.array(), "website": F.col("website"), "sectors": F.array(F.lit("technology")), "country": F.lit("Nepal"),
        "nepal_relationship": F.lit("based"), "profile": F.col("profile"), "locality": F.col("locality"), "confidence": F.lit(0.6), "observed_at": F.col("observed_at"),
    }))


CONNECTORS: dict[str, Callable[[DataFrame, Source], Batch]] = {
    f.__name__: f for f in (remoteok, remotive, himalayas, greenhouse, lever, ashby, brave_search, google_places, manual_csv, html_directory)
}


def connector(source: Source) -> Callable[[DataFrame, Source], Batch]:
    if source.connector not in CONNECTORS:
        raise ValueError(f"no connector {source.connector}")
    return CONNECTORS[source.connector]
