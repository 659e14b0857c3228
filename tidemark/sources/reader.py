"""A Spark data source of listing pages: `spark.read.format("tidemark_listing")`.

Each slice of a listing is one input partition; its pages are followed inside the partition. A source's rate limit holds
within a task, so all slices of one source go to one partition unless `parallel` says otherwise. Options: `fonte`,
`canal`, `fatias` (JSON list of objects with at least `url`, and `params`), `por_minuto`, `robots`, `parallel`, and
`replay`, a folder of recorded responses used instead of the network.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark.sources.client import Client, FetchError, Response, RobotsBlocked, urllib_transport
from tidemark.sources.links import article_links

#: Articles above which a day's query is cut and has to be asked in bands.
GDELT_CAP = 250
#: Requests a minute to the archive for versions of topic pages.
ARCHIVE_RATE = 15
SCHEMA = "fonte string, fatia string, pagina int, base string, corpo string, erro string"


def replay_name(url: str) -> str:
    return hashlib.sha256(url.encode()).hexdigest()[:24] + ".body"


def replay_transport(folder: str):
    """Recorded bodies by address; anything else is a 404."""

    def send(url, headers, timeout) -> Response:
        path = Path(folder) / replay_name(url)
        return Response(200, url, path.read_bytes()) if path.exists() else Response(404, url, b"")

    return send


def next_params(channel: str, params: dict, body: bytes, page: int) -> dict | None:
    """Parameters of the page after this one, or null at the end."""
    if channel == "wayback":
        rows = json.loads(body or b"[]")
        key = rows[-1][0] if len(rows) >= 3 and rows[-2] == [] and len(rows[-1]) == 1 else None
        return params | {"resumeKey": key} if key else None
    if channel in ("openalex", "crossref"):
        data = json.loads(body)
        data = data.get("message") or {} if channel == "crossref" else data
        rows = data.get("items" if channel == "crossref" else "results")
        cursor = data.get("next-cursor") if channel == "crossref" else (data.get("meta") or {}).get("next_cursor")
        return params | {"cursor": cursor} if rows and cursor else None
    if channel == "ia":
        docs = (json.loads(body).get("response") or {}).get("docs") or []
        return params | {"page": str(page + 2)} if len(docs) >= int(params.get("rows", 100)) else None
    if channel == "wikipedia":
        more = json.loads(body).get("continue")
        return params | more if more else None
    return None


def bands(params: dict) -> list[dict]:
    """A day's query as four of six hours."""
    day, end = params["startdatetime"][:8], params["enddatetime"]
    marks = [f"{day}{h:02d}0000" for h in (0, 6, 12, 18)] + [end]
    return [params | {"startdatetime": a, "enddatetime": b} for a, b in zip(marks, marks[1:])]


class _Slices(InputPartition):
    def __init__(self, slices: list[dict]):
        self.slices = slices


class ListingReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        slices = json.loads(self.options["fatias"])
        n = max(1, int(self.options.get("parallel", 1)))
        return [_Slices(slices[i::n]) for i in range(n) if slices[i::n]]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        o = self.options
        send = replay_transport(o["replay"]) if "replay" in o else urllib_transport
        client = Client(int(o.get("por_minuto", 20)), o.get("robots", "false") == "true", send)
        for s in partition.slices:
            name, params, page = s.get("fatia", s["url"]), s.get("params") or {}, 0
            if o["canal"] == "topico":
                yield from self._topic(client, Client(ARCHIVE_RATE, False, send), s)
                continue
            try:
                while params is not None:
                    got = client.get(s["url"], params)
                    if o["canal"] == "gdelt" and len(json.loads(got.body).get("articles") or []) >= GDELT_CAP:
                        for b in bands(params):  # a full day is asked again; the cut answer is dropped
                            yield o["fonte"], name, page, s["url"], client.get(s["url"], b).body.decode("utf-8", "replace"), None
                            page += 1
                        break
                    yield o["fonte"], name, page, got.url, got.body.decode("utf-8", "replace"), None
                    params, page = next_params(o["canal"], params, got.body, page), page + 1
            except (FetchError, ValueError) as e:  # pages read before the failure stay
                yield o["fonte"], name, page, s["url"], None, str(e)


    def _topic(self, client: Client, archive: Client, s: dict) -> Iterator[tuple]:
        """Pages of a topic until one has no new link or can't be read, then one archived version of each year.

        A topic that robots.txt closes is an error, unless its archived versions are asked for.
        """
        source, name, seen, page = self.options["fonte"], s.get("fatia", s["url"]), set(), 0
        try:
            for url in s["paginas"]:
                got = client.get(url)
                body = got.body.decode("utf-8", "replace")
                if seen.issuperset(links := article_links(body, url)):
                    break
                seen.update(links)
                yield source, name, page, got.url, body, None
                page += 1
        except RobotsBlocked as e:
            if "arquivo" not in s:
                yield source, name, page, s["url"], None, str(e)
        except FetchError:
            pass  # past the last page
        try:
            rows = json.loads(archive.get(s["arquivo"], s["arquivo_params"]).body or b"[]") if "arquivo" in s else []
        except (FetchError, ValueError) as e:
            yield source, name, page, s["url"], None, str(e)
            return
        for stamp, original, *_ in filter(None, rows[1:]):
            url = f"https://web.archive.org/web/{stamp}id_/{original}"
            try:
                yield source, name, page, url, archive.get(url).body.decode("utf-8", "replace"), None
                page += 1
            except FetchError:
                continue  # a version that can't be read leaves the others


class ListingSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidemark_listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ListingReader:
        return ListingReader(self.options)


def register(spark) -> None:
    spark.dataSource.register(ListingSource)
