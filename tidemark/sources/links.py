"""Absolute link targets of pages; relative addresses need Python's resolution rules."""

from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import urldefrag, urljoin, urlsplit

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: addresses on topic pages that lead to listings, feeds and media.
NAVIGATION = (
    r"(?i)/(tag|tags|tema|temas|topico|topicos|tudo-sobre|autor|autores|author|category|categoria|categorias|assunto|"
    r"assuntos|page|pagina|search|busca|feed|wp-|amp)(/|$)|[?&](s|q|busca|page|pagina)=|/feed$|\.(xml|rss|jpg|jpeg|png|gif|pdf|mp3|mp4)$"
)
_SKIP = ("#", "mailto:", "javascript:", "tel:")


class _Anchors(HTMLParser):
    def __init__(self, markup: str):
        super().__init__()
        self.targets: list[str] = []
        self.feed(markup)
        self.close()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        target = dict(attrs).get("href") if tag == "a" else None
        if target and not target.startswith(_SKIP):
            self.targets.append(target.strip())


def article_links(markup: str, base: str) -> list[str]:
    """Links of a topic page to articles of the same site, resolved, without fragment and slash at the end."""
    host = lambda u: urlsplit(u).netloc.lower().removeprefix("www.").partition(":")[0]
    labels = host(base).split(".")
    home = ".".join(labels[-3:] if len(labels) > 2 and len(labels[-2]) <= 3 else labels[-2:])
    out = []
    for target in _Anchors(markup).targets:
        try:
            url = urldefrag(urljoin(base, target))[0]
            own = host(url) == home or host(url).endswith(f".{home}")
        except ValueError:
            continue
        if own and len(urlsplit(url).path.strip("/")) >= 8 and not re.search(NAVIGATION, url):
            out.append(url.rstrip("/"))
    return out


@F.pandas_udf(T.ArrayType(T.StringType()))
def anchors(markup: pd.Series, base: pd.Series) -> pd.Series:
    """Targets of all anchors in order, resolved against the page's own address; null markup has none."""

    def one(m: str | None, b: str | None) -> list[str]:
        out = []
        for t in _Anchors(m).targets if m else []:
            try:
                out.append(urljoin(b or "", t))
            except ValueError:  # an address that can't be resolved leads nowhere
                continue
        return out

    return pd.Series([one(m, b) for m, b in zip(markup, base)])
