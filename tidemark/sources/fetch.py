"""Fetching documents of references: one polite client per source and task."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from tidemark.sources.client import Client, FetchError, RobotsBlocked, urllib_transport
from tidemark.sources.listing import CDX
from tidemark.sources.reader import replay_transport

RESPONSES = "url string, status int, corpo binary, cabecalhos map<string,string>"


def fetch(refs: DataFrame, per_minute: int | dict[str, int] = 20, robots: bool = True, replay: str | None = None) -> DataFrame:
    """(url, status, corpo, cabecalhos) of each distinct address; status -1 is forbidden, null a failure.

    per_minute: a limit for all sources, or one for each.

    References of one source go to one task, as its rate limit holds there; fetching is bound by that limit, not by data.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        clients: dict[str, Client] = {}
        for b in batches:
            rows = []
            for r in b.itertuples():
                client = clients.setdefault(r.fonte, Client(per_minute.get(r.fonte, 20) if isinstance(per_minute, dict) else per_minute, robots, replay_transport(replay) if replay else urllib_transport))
                try:
                    got = client.get(r.url)
                    rows.append((r.url, got.status, got.body, {k: v for k, v in got.headers.items() if k in ("content-type", "last-modified")}))
                except RobotsBlocked:
                    rows.append((r.url, -1, None, None))
                except FetchError:
                    rows.append((r.url, None, None, None))
            out = pd.DataFrame(rows, columns=["url", "status", "corpo", "cabecalhos"])
            out["status"] = out["status"].astype("Int32")
            yield out

    return refs.select("fonte", "url").distinct().repartition("fonte").mapInPandas(run, RESPONSES)


CAPTURES = "id string, carimbo string"


def latest_captures(rows: DataFrame, per_minute: int = 15, replay: str | None = None) -> DataFrame:
    """(id, carimbo): the archive's last sound capture of each (id, url), asked address by address; none where it has none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = Client(per_minute, False, replay_transport(replay) if replay else urllib_transport)
        for b in batches:
            found = []
            for r in b.itertuples():
                ask = {"url": r.url, "matchType": "exact", "filter": "statuscode:200", "output": "json", "fl": "timestamp,original", "limit": "-1"}
                try:
                    got = [x for x in json.loads(client.get(CDX, ask).body or b"[]")[1:] if x]
                except (FetchError, ValueError):
                    continue
                found += [(r.id, got[-1][0])] if got else []
            yield pd.DataFrame(found, columns=["id", "carimbo"])

    return rows.select("id", "url").distinct().coalesce(1).mapInPandas(run, CAPTURES)  # one task, as the limit holds for all
