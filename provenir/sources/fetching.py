"""Fetching as a Spark data source: a partition for each host, each with a pace of its own; cursors as offsets of a stream."""

from __future__ import annotations

import base64
import hashlib
import json
from collections import defaultdict
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from pathlib import Path
from urllib.parse import urlencode, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

from ..sinks.archive import FolderStore
from .http import Fetcher, Response

SCHEMA = (
    "seq long, url string, content binary, observed_at timestamp, status_code int, content_type string, etag string, last_modified string, "
    "pointer string, error string"
)


def replayed(folder: str) -> Callable:
    """A transport that answers from files, `<sha256 of the URL>.body` and, if it is there, `.json` (status and headers); 404 else."""

    def send(method: str, url: str, headers: dict[str, str], body: bytes | None) -> Response:
        at = Path(folder) / hashlib.sha256(url.encode()).hexdigest()
        if not at.with_suffix(".body").exists():
            return Response(url, 404, {}, b"")
        told = json.loads(at.with_suffix(".json").read_text()) if at.with_suffix(".json").exists() else {}
        return Response(url, told.get("status", 200), told.get("headers", {}), at.with_suffix(".body").read_bytes())

    return send


def keep_answer(folder: str | Path, url: str, content: bytes, status: int = 200, headers: dict[str, str] | None = None) -> None:
    """Writes an answer where `replayed` finds it."""
    at = Path(folder) / hashlib.sha256(url.encode()).hexdigest()
    at.parent.mkdir(parents=True, exist_ok=True)
    at.with_suffix(".body").write_bytes(content)
    at.with_suffix(".json").write_text(json.dumps({"status": status, "headers": headers or {}}))


class _Host(InputPartition):
    """The requests to one host, in order."""

    def __init__(self, host: str, requests: list[dict]):
        super().__init__(host)
        self.requests = requests


def _fetcher(options: dict[str, str]) -> Fetcher:
    pace, agent = int(options.get("requests_per_minute", 30)), options.get("agent", "provenir/0.1")
    if "replay" in options:  # no network: no name is resolved, nothing waits
        return Fetcher(pace, agent, replayed(options["replay"]), lambda *_a, **_k: [], lambda _s: None)
    return Fetcher(pace, agent)


def _row(options: dict[str, str], seq: int, request: dict, fetcher: Fetcher) -> tuple:
    now = datetime.now(UTC)
    try:
        body = base64.b64decode(request["body"]) if request.get("body") else None
        got = fetcher.fetch(request["url"], request.get("method", "GET"), request.get("headers"), body, obey_robots=options.get("obey_robots") == "true")
        if got.status >= 400:
            raise OSError(f"{got.url} answered {got.status}")
    except (OSError, ValueError) as e:
        if options.get("on_error", "fail") == "fail":
            raise
        return seq, request["url"], None, now, None, None, None, None, None, str(e)
    pointer = None
    if "archive" in options:
        meta = {"url": got.url, "fetched_at": now.isoformat(), "status": got.status, "content_type": got.headers.get("content-type")}
        pointer = FolderStore(options["archive"]).put(options.get("source", ""), options.get("run", ""), got.content, meta)
    return seq, got.url, got.content, now, got.status, got.headers.get("content-type"), got.headers.get("etag"), got.headers.get("last-modified"), pointer, None


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = dict(options)

    def partitions(self) -> list[_Host]:
        by_host: dict[str, list[dict]] = defaultdict(list)
        for seq, request in enumerate(json.loads(self.options["requests"])):
            by_host[urlsplit(request["url"]).hostname or ""].append({"seq": seq} | request)
        return [_Host(h, r) for h, r in sorted(by_host.items())]

    def read(self, partition: _Host) -> Iterator[tuple]:
        fetcher = _fetcher(self.options)
        for request in partition.requests if partition else []:  # without requests there is one partition, None
            yield _row(self.options, request["seq"], request, fetcher)


class _Cursor(SimpleDataSourceStreamReader):
    """Pages that name the next one: an offset is the cursor of the next page and the pages read so far."""

    def __init__(self, options: dict[str, str]):
        self.options = dict(options)

    def initialOffset(self) -> dict:
        return {"cursor": "", "page": 0}

    def _page(self, offset: dict) -> tuple[tuple, dict]:
        base = self.options["url"]
        query = {"limit": self.options.get("limit", "20")} | ({"cursor": offset["cursor"]} if offset["cursor"] else {})
        row = _row(self.options, offset["page"], {"url": base + ("&" if urlsplit(base).query else "?") + urlencode(query)}, _fetcher(self.options))
        from .feeds import next_cursor

        following = next_cursor(row[2].decode("utf-8-sig")) if row[2] else None
        return row, {"cursor": following or "", "page": -1 if not following else offset["page"] + 1}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        if start["page"] < 0 or start["page"] >= int(self.options.get("max_pages", 100)):
            return iter([]), start
        row, after = self._page(start)
        return iter([row]), after

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        at = start
        while at != end:
            row, at = self._page(at)
            yield row


class FetchSource(DataSource):
    """`provenir_fetch`: answers as rows of `SCHEMA`, fetched on the executors, one partition for each host.

    Options: `requests` (JSON list of url, method, headers, body in base64), `requests_per_minute` (of each host), `agent`, `obey_robots`,
    `on_error` (fail, or row: the row says why), `archive` (a shared folder that answers are kept in first, with `source` and `run`),
    `replay` (a folder of answers in place of the network). As a stream: `url`, `limit` and `max_pages`, a page a batch.
    """

    @classmethod
    def name(cls) -> str:
        return "provenir_fetch"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)

    def simpleStreamReader(self, schema) -> _Cursor:
        return _Cursor(self.options)


def fetched(spark: SparkSession, requests: list[dict], **options: str) -> DataFrame:
    """The answers to `requests`, in rows of `SCHEMA`."""
    spark.dataSource.register(FetchSource)
    told = [r | ({"body": base64.b64encode(r["body"]).decode()} if r.get("body") else {}) for r in requests]
    return spark.read.format("provenir_fetch").options(requests=json.dumps(told), **options).load()

