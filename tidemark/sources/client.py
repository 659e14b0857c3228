"""A polite HTTP client with an injectable transport, clock and sleep."""

from __future__ import annotations

import json
import re
import time
import urllib.error
import urllib.parse
import urllib.request
import urllib.robotparser
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from tidemark.functions.text import SECRET

RETRY = frozenset((408, 425, 429, 500, 502, 503, 504))
AGENT = "tidemark/0.1"


@dataclass(frozen=True)
class Response:
    status: int
    url: str
    body: bytes
    headers: Mapping[str, str] = field(default_factory=dict)

    def json(self):
        return json.loads(self.body)


Transport = Callable[[str, Mapping[str, str], float], Response]


class FetchError(RuntimeError):
    """A request that failed for good; the message holds no secrets."""


class RobotsBlocked(FetchError):
    """robots.txt forbids the address."""


class GeoBlocked(FetchError):
    """The origin answers requests from other countries only."""


# What refusals by country say.
GEO_MARKS = (b"block access from your country", b"not available in your country", b"geo-restricted")


def redacted(text: str) -> str:
    return re.sub(SECRET, r"\1<redigido>", text)


def urllib_transport(url: str, headers: Mapping[str, str], timeout: float) -> Response:
    request = urllib.request.Request(url, headers=dict(headers))
    try:
        with urllib.request.urlopen(request, timeout=timeout) as r:
            return Response(r.status, r.url, r.read(), {k.lower(): v for k, v in r.headers.items()})
    except urllib.error.HTTPError as e:
        return Response(e.code, url, e.read(), {k.lower(): v for k, v in e.headers.items()})


class Client:
    """At most `per_minute` requests; transient failures are tried again with growing pauses; robots.txt on request.

    A missing robots.txt allows everything, one that is refused (401, 403) forbids everything.
    """

    def __init__(self, per_minute: int, robots: bool = True, transport: Transport = urllib_transport, attempts: int = 4, timeout: float = 60.0, clock=time.monotonic, sleep=time.sleep):
        self.interval, self.robots, self.transport, self.attempts, self.timeout = 60.0 / per_minute, robots, transport, attempts, timeout
        self.clock, self.sleep = clock, sleep
        self.last: float | None = None
        self.rules: dict[str, urllib.robotparser.RobotFileParser] = {}

    def _send(self, url: str) -> Response:
        failure = ""
        for n in range(1, self.attempts + 1):
            if self.last is not None and (pause := self.last + self.interval - self.clock()) > 0:
                self.sleep(pause)
            self.last = self.clock()
            try:
                got = self.transport(url, {"User-Agent": AGENT}, self.timeout)
                if got.status not in RETRY:
                    return got
                failure = f"HTTP {got.status}"
            except (OSError, TimeoutError) as e:
                failure = f"{type(e).__name__}: {e}"
            if n < self.attempts:
                self.sleep(min(60.0, 2.0**n))
        raise FetchError(redacted(f"GET {url}: {failure} after {self.attempts} attempts"))

    def allowed(self, url: str) -> bool:
        site = "{0.scheme}://{0.netloc}".format(urllib.parse.urlsplit(url))
        if site not in self.rules:
            got = self._send(f"{site}/robots.txt")
            rules = urllib.robotparser.RobotFileParser()
            rules.modified()
            rules.disallow_all = got.status in (401, 403)
            rules.allow_all = got.status >= 400 and not rules.disallow_all
            if got.status < 400:
                rules.parse(got.body.decode("utf-8", "replace").splitlines())
            self.rules[site] = rules
        return self.rules[site].can_fetch(AGENT, url)

    def get(self, url: str, params: Mapping[str, str] | list | None = None) -> Response:
        if params:
            url += ("&" if "?" in url else "?") + urllib.parse.urlencode(params, doseq=True)
        if self.robots and not self.allowed(url):
            raise RobotsBlocked(redacted(f"robots.txt forbids {url}"))
        got = self._send(url)
        if got.status == 403 and any(m in got.body for m in GEO_MARKS):
            raise GeoBlocked(redacted(f"GET {url}: refused from this country"))
        if not 200 <= got.status < 300:
            raise FetchError(redacted(f"GET {url}: HTTP {got.status}: {got.body[:300].decode('utf-8', 'replace')}"))
        return got
