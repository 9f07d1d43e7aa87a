"""Fetches what a source's connector reads."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import UTC, datetime
from urllib.parse import urlencode, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import feeds
from ..functions import ids
from .catalog import Source
from .fetching import fetched
from ..sinks.archive import ArchiveStore
from ..staging import staged
from .http import Fetcher

BOARD_URLS = {
    "greenhouse": "https://boards-api.greenhouse.io/v1/boards/{token}/jobs?content=true",
    "lever": "https://api.lever.co/v0/postings/{token}?mode=json",
    "ashby": "https://api.ashbyhq.com/posting-api/job-board/{token}?includeCompensation=true",
}


def requests_of(source: Source, keys: dict[str, str]) -> list[dict]:
    """The requests that need no answer before: url, method, headers and body."""
    if source.connector in BOARD_URLS:
        return [{"url": BOARD_URLS[source.connector].format(token=b["token"])} for b in feeds._boards(source)]
    if source.connector == "brave_search":
        if not keys.get("BRAVE_SEARCH_API_KEY"):
            raise ValueError("BRAVE_SEARCH_API_KEY is not set")
        return [{"url": f"{source.base_url}?{urlencode({'q': q, 'country': 'NP', 'count': 20})}", "headers": {"X-Subscription-Token": keys["BRAVE_SEARCH_API_KEY"]}} for q in source.parameter("queries")]
    if source.connector == "google_places":
        if not keys.get("GOOGLE_PLACES_API_KEY"):
            raise ValueError("GOOGLE_PLACES_API_KEY is not set")
        headers = {"X-Goog-Api-Key": keys["GOOGLE_PLACES_API_KEY"], "X-Goog-FieldMask": "places.id,nextPageToken", "Content-Type": "application/json"}
        return [{"url": source.base_url, "method": "POST", "headers": headers, "body": json.dumps({"textQuery": q}).encode()} for q in source.parameter("queries")]
    return [{"url": source.base_url}]


def spread(spark: SparkSession, source: Source, keys: dict[str, str] | None = None, archive: str | None = None, run: str = "", **options: str) -> feeds.Batch:
    """`collect` with the executors as fetchers: hosts side by side, each at the pace of the source; no answer passes through the
    driver. `archive`: a shared folder. Sources of cursors or of files are collected by `collect`."""
    if source.connector in ("himalayas", "manual_csv"):
        raise ValueError(f"{source.id}: pages of one cursor follow each other")
    robots = source.obey_robots and source.access_mode in ("html", "feed")
    options |= {"requests_per_minute": str(source.requests_per_minute), "obey_robots": str(robots).lower(), "source": source.id, "run": run} | ({"archive": archive} if archive else {})
    answers = staged(fetched(spark, requests_of(source, keys or {}), **options).drop("error"), "answers")  # fetched once
    batch = feeds.connector(source)(answers.drop("pointer"), source)
    batch.documents = document_rows(answers, source, run)
    return batch


def document_rows(answers: DataFrame, source: Source, run: str) -> DataFrame:
    """Rows of source_documents for fetched answers."""
    sha = ids.content_hash(F.col("content"))
    return answers.select(
        ids.stable_id("document", F.lit(source.id), F.lower("url"), sha).alias("document_id"), F.lit(run).alias("run_id"), F.lit(source.id).alias("source_id"), "url", F.col("observed_at").alias("fetched_at"), "status_code", "content_type",
        "etag", "last_modified", sha.alias("content_sha256"), F.coalesce("pointer", F.lit("")).alias("storage_pointer"), F.lit(source.redistribution).alias("redistribution"), F.lit(source.raw_retention_days).alias("raw_retention_days"), F.lit("parsed").alias("parse_status"),
    )


def collect(spark: SparkSession, source: Source, fetcher: Fetcher | None = None, keys: dict[str, str] | None = None, archive: ArchiveStore | None = None, run: str = "", report: Callable = lambda *_a, **_k: None) -> feeds.Batch:
    """Fetches a source and reads it: candidates and document rows. With an `archive` each answer is kept first, and its row says where."""
    read = feeds.connector(source)
    if source.connector == "manual_csv":
        return read(feeds.read_manual_csv(spark, source.parameter("path")), source)
    fetcher = fetcher or Fetcher(source.requests_per_minute, report=report)
    robots = source.obey_robots and source.access_mode in ("html", "feed")
    got = []
    if source.connector == "himalayas":
        cursor, most = None, int(source.parameters.get("max_pages", 100))
        while len(got) < most:
            sep = "&" if urlsplit(source.base_url).query else "?"
            got.append(fetcher.fetch(source.base_url + sep + urlencode({"limit": 20} | ({"cursor": cursor} if cursor else {})), obey_robots=robots))
            cursor = feeds.next_cursor(got[-1].content.decode("utf-8-sig"))
            if not cursor:
                break
    else:
        got = [fetcher.fetch(obey_robots=robots, **r) for r in requests_of(source, keys or {})]
    bad = [r for r in got if r.status >= 400]
    if bad:
        raise OSError(f"{bad[0].url} answered {bad[0].status}")
    now = datetime.now(UTC)
    pointers = [None] * len(got)
    if archive:
        report("archive_started", source=source.id, documents=len(got))
        pointers = [archive.put(source.id, run, r.content, {"url": r.url, "fetched_at": now.isoformat(), "status": r.status, "content_type": r.headers.get("content-type")}) for r in got]
        report("archive_completed", source=source.id, documents=len(got))
    rows = [(i, r.url, bytearray(r.content), now, r.status, r.headers.get("content-type"), r.headers.get("etag"), r.headers.get("last-modified"), at) for i, (r, at) in enumerate(zip(got, pointers))]
    fetched_rows = spark.createDataFrame(rows, "seq long, url string, content binary, observed_at timestamp, status_code int, content_type string, etag string, last_modified string, pointer string")
    batch = read(fetched_rows.drop("pointer"), source)
    batch.documents = document_rows(fetched_rows, source, run)
    return batch
