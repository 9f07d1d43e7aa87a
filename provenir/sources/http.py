"""Fetching: public addresses only, bounded in size, redirects, retries and pace."""

from __future__ import annotations

import ipaddress
import socket
import time
import urllib.error
import urllib.request
import urllib.robotparser
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime
from email.utils import parsedate_to_datetime
from urllib.parse import urljoin, urlsplit

MOST_HOPS, MOST_BYTES, TIMEOUT_S, ATTEMPTS, MOST_WAIT_S = 5, 10_000_000, 30, 3, 30
RETRIED = {429, 500, 502, 503, 504}


class UnsafeUrl(ValueError):
    """A URL that must not be fetched."""


def validate_public_url(url: str, resolve: Callable = socket.getaddrinfo) -> None:
    """http(s), a host, no credentials, and only global addresses behind the name."""
    parts = urlsplit(url)
    if parts.scheme not in ("http", "https") or not parts.hostname or parts.username or parts.password:
        raise UnsafeUrl(url)
    for *_, address in resolve(parts.hostname, parts.port or (443 if parts.scheme == "https" else 80), proto=socket.IPPROTO_TCP):
        if not ipaddress.ip_address(address[0]).is_global:
            raise UnsafeUrl(url)


def retry_after(value: str | None, attempt: int, now: datetime | None = None) -> float:
    """Seconds to wait before another try: what the server says, else 2^attempt; at most half a minute."""
    wait = float(2**attempt)
    if value:
        try:
            wait = float(value)
        except ValueError:
            try:
                wait = (parsedate_to_datetime(value) - (now or datetime.now(UTC))).total_seconds()
            except (TypeError, ValueError):
                pass
    return min(max(wait, 0.0), MOST_WAIT_S)


@dataclass
class Response:
    url: str
    status: int
    headers: dict[str, str]
    content: bytes


class _NoRedirect(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, *_args, **_kwargs):
        return None


class Fetcher:
    """Fetches for one source, one request at a time; the transport can be replaced."""

    def __init__(self, requests_per_minute: int = 30, agent: str = "provenir/0.1", transport: Callable | None = None, resolve: Callable = socket.getaddrinfo, sleep: Callable = time.sleep, report: Callable = lambda *_a, **_k: None):
        self._report = report
        self._gap, self._agent, self._send, self._resolve, self._sleep = 60 / requests_per_minute, agent, transport or self._open, resolve, sleep
        self._last: dict[str, float] = {}
        self._robots: dict[str, urllib.robotparser.RobotFileParser | None] = {}

    def _open(self, method: str, url: str, headers: dict[str, str], body: bytes | None) -> Response:
        request = urllib.request.Request(url, data=body, method=method, headers={"User-Agent": self._agent, **headers})
        opener = urllib.request.build_opener(_NoRedirect)
        try:
            got = opener.open(request, timeout=TIMEOUT_S)
        except urllib.error.HTTPError as e:
            got = e
        with got:
            if int(got.headers.get("Content-Length") or 0) > MOST_BYTES:
                raise ValueError("the response is too large")
            content = got.read(MOST_BYTES + 1)
        if len(content) > MOST_BYTES:
            raise ValueError("the response is too large")
        return Response(url, got.status, {k.lower(): v for k, v in got.headers.items()}, content)

    def _paced(self, url: str) -> None:
        host = urlsplit(url).hostname or ""
        wait = self._last.get(host, float("-inf")) + self._gap - time.monotonic()
        if wait > 0:
            self._sleep(wait)
        self._last[host] = time.monotonic()

    def _tried(self, method: str, url: str, headers: dict[str, str], body: bytes | None) -> Response:
        for attempt in range(ATTEMPTS):
            self._paced(url)
            try:
                got = self._send(method, url, headers, body)
            except OSError as e:  # timeouts and network errors, which urllib wraps in URLError
                if isinstance(e, PermissionError) or attempt == ATTEMPTS - 1:
                    raise
                self._report("fetch_retried", url=url, attempt=attempt + 1, error=str(e))
                self._sleep(retry_after(None, attempt))
                continue
            if got.status not in RETRIED or attempt == ATTEMPTS - 1:
                return got
            self._report("fetch_retried", url=url, attempt=attempt + 1, status=got.status)
            self._sleep(retry_after(got.headers.get("retry-after"), attempt))
        raise AssertionError("unreachable")

    def allowed(self, url: str) -> bool:
        """What robots.txt says; an answer of 400 or more allows all, no answer fails."""
        parts = urlsplit(url)
        origin = f"{parts.scheme}://{parts.netloc}"
        if origin not in self._robots:
            validate_public_url(origin, self._resolve)
            got = self._tried("GET", f"{origin}/robots.txt", {}, None)
            rules = None
            if got.status < 400:
                rules = urllib.robotparser.RobotFileParser()
                rules.parse(got.content.decode("utf-8", "replace").splitlines())
            self._robots[origin] = rules
        rules = self._robots[origin]
        return rules is None or rules.can_fetch(self._agent, url)

    def fetch(self, url: str, method: str = "GET", headers: dict[str, str] | None = None, body: bytes | None = None, obey_robots: bool = False, etag: str | None = None, modified: str | None = None) -> Response:
        """The answer after up to five redirects, each checked like the first; 303 turns into GET."""
        began = time.monotonic()
        self._report("fetch_started", url=url)
        conditional = {k: v for k, v in (("If-None-Match", etag), ("If-Modified-Since", modified)) if v}
        for _ in range(MOST_HOPS + 1):
            validate_public_url(url, self._resolve)
            if obey_robots and not self.allowed(url):
                raise PermissionError(f"robots.txt forbids {url}")
            got = self._tried(method, url, {**conditional, **(headers or {})}, body)
            target = got.headers.get("location")
            if got.status not in (301, 302, 303, 307, 308) or not target:
                self._report("fetch_completed", url=url, status=got.status, bytes=len(got.content), elapsed=round(time.monotonic() - began, 3))
                return Response(url, got.status, got.headers, got.content)
            url = urljoin(url, target)
            if got.status == 303:
                method, body = "GET", None
        raise ValueError("too many redirects")
