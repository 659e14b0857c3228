"""What the listing reader has to ask of each channel: addresses and parameters, slice by slice."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from urllib.parse import urljoin

CDX = "https://web.archive.org/cdx/search/cdx"
FIRST_CAPTURE = date(1996, 1, 1)
GDELT_DAYS = 90
#: Requests a minute of each channel where a source sets none.
RATES = {"wayback": 15, "topico": 12, "rss": 20, "gdelt": 12, "openalex": 30, "crossref": 30, "ia": 20, "wikipedia": 30, "lista": 10}


def rate(source: dict) -> int:
    return int(source.get("limite_por_minuto", RATES.get(source["tipo"], 20)))


def topic_page(url: str, pattern: str, n: int) -> str:
    """Address of the n-th page of a topic: the topic itself, its query with one more value, or a path below it."""
    suffix = pattern.format(n=n)
    if n == 1:
        return url
    if not suffix.startswith("?"):
        return urljoin(url.rstrip("/") + "/", suffix)
    return f"{url}&{suffix[1:]}" if "?" in url else url.rstrip("/") + suffix


def archive_prefixes(source: dict) -> tuple[list[str], bool]:
    """(prefixes, whole): a source lists sections year by year, or a whole domain at once."""
    sections = [p.strip() for p in source.get("prefixos") or [] if p.strip()]
    if sections:
        return sections, source.get("fatia", "ano") == "tudo"
    if not source.get("dominio"):
        raise ValueError(f"{source.get('id')}: needs prefixos or dominio")
    return [source["dominio"]], source.get("fatia", "tudo") == "tudo"


def archive_slice(source: dict, prefix: str, year: int | None, begin: date, end: date | None) -> dict:
    """One query of the archive's index; the url pattern, the status and the type are filtered there."""
    params = {
        "url": prefix,
        "matchType": "prefix" if source.get("prefixos") else "domain",
        "filter": [f"original:{source.get('filtro', '.*')}", "statuscode:200", "mimetype:text/html"],
        "collapse": "urlkey",
        "output": "json",
        "fl": "timestamp,original,statuscode,mimetype,digest",
        "from": f"{begin:%Y%m%d}",
    }
    if end:
        params["to"] = f"{end:%Y%m%d}"
    params |= {"limit": str(source.get("por_pagina", 500)), "showResumeKey": "true"}
    return {"url": CDX, "fatia": f"{prefix}|{'tudo' if year is None else year}", "params": params}


def _rss(s: dict, since: date, today: date) -> list[dict]:
    return [{"url": s["url"]}]


def _openalex(s: dict, since: date, today: date) -> list[dict]:
    return [{"url": "https://api.openalex.org/works", "params": {"search": s["busca"], "filter": f"from_publication_date:{since}", "per-page": "200", "cursor": "*"}}]


def _crossref(s: dict, since: date, today: date) -> list[dict]:
    return [{"url": "https://api.crossref.org/works", "params": {"query": s["busca"], "filter": f"from-pub-date:{since}", "rows": "200", "cursor": "*"}}]


def _ia(s: dict, since: date, today: date) -> list[dict]:
    ask = f"({s['busca']}) AND publicdate:[{since} TO null]"
    return [{"url": "https://archive.org/advancedsearch.php", "params": {"q": ask, "fl[]": "identifier,title,description,mediatype,date,publicdate", "rows": "100", "page": "1", "output": "json"}}]


def _wikipedia(s: dict, since: date, today: date) -> list[dict]:
    api = f"https://{s.get('idioma', 'pt')}.wikipedia.org/w/api.php"
    return [{"url": api, "fatia": t, "params": {"action": "query", "prop": "extlinks", "titles": t, "ellimit": "500", "format": "json", "formatversion": "2"}} for t in s["titulos"]]


def _gdelt(s: dict, since: date, today: date) -> list[dict]:
    first = effective_start(s, since, today)
    base = {"query": s["busca"], "mode": "artlist", "format": "json", "maxrecords": "250", "sort": "datedesc"}
    days = [first + timedelta(days=n) for n in range((today - first).days + 1)]
    return [{"url": "https://api.gdeltproject.org/api/v2/doc/doc", "fatia": str(d), "params": base | {"startdatetime": f"{d:%Y%m%d}000000", "enddatetime": f"{d + timedelta(days=1):%Y%m%d}000000"}} for d in days]


def _topic(s: dict, since: date, today: date) -> list[dict]:
    """One slice: the reader goes from page to page until one brings no new link."""
    pages = [topic_page(s["url"], s.get("paginacao", "page/{n}/"), n) for n in range(1, int(s.get("max_paginas", 40)) + 1)]
    archived = {"url": s["url"], "matchType": "exact", "filter": "statuscode:200", "collapse": "timestamp:4", "output": "json", "fl": "timestamp,original", "from": f"{since:%Y%m%d}"}
    return [{"url": s["url"], "fatia": "topico", "paginas": pages} | ({"arquivo": CDX, "arquivo_params": archived} if s.get("arquivadas") else {})]


def _archive(s: dict, since: date, today: date) -> list[dict]:
    """Every slice of the window; a run asks only for those that aren't done and fit its budget."""
    prefixes, whole = archive_prefixes(s)
    start = effective_start(s, since, today)
    years = [(None, start, None)] if whole else [(y, start if y == start.year else date(y, 1, 1), date(y, 12, 31) if y < today.year else None) for y in range(start.year, today.year + 1)]
    return [archive_slice(s, p, *y) for p in prefixes for y in years]


SLICES: dict[str, Callable[[dict, date, date], list[dict]]] = {
    "rss": _rss, "openalex": _openalex, "crossref": _crossref, "ia": _ia, "wikipedia": _wikipedia, "gdelt": _gdelt, "topico": _topic, "wayback": _archive, "lista": lambda s, since, today: [],
}


def effective_start(source: dict, since: date, today: date) -> date:
    """The first day a channel can list, where it is later than asked for."""
    if source["tipo"] == "wayback":
        return max(since, FIRST_CAPTURE)
    if source["tipo"] == "gdelt":
        return max(since, today - timedelta(days=GDELT_DAYS))
    return since


def listing_slices(source: dict, since: date, today: date) -> list[dict]:
    return SLICES[source["tipo"]](source, since, today)
