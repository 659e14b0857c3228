"""Recorded payloads of the channels as references: one DataFrame parser per payload format.

Input rows are (fonte, pagina, corpo): a response body with its page number. Output rows are references: fonte,
id_na_fonte, url, titulo, publicado_em, dados (map) and ord, the position in the listing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.functions import url as U
from tidemark.operators.slices import is_noise
from tidemark.operators.state import first_wins
from tidemark.sources.links import NAVIGATION, anchors

REFERENCE = ["fonte", "id_na_fonte", "url", "titulo", "publicado_em", "dados", "ord"]
def _order(page: str = "pagina", at: str = "_i") -> Column:
    return (F.col(page).cast("bigint") * 1_000_000 + F.col(at)).alias("ord")


def _refs(df: DataFrame, id_: Column, url: Column, title: Column, day: Column, extra: dict[str, Column]) -> DataFrame:
    pairs = [x for k, v in extra.items() for x in (F.lit(k), F.coalesce(v.cast("string"), F.lit("")))]
    data = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,string>")
    return df.select("fonte", id_.alias("id_na_fonte"), url.alias("url"), title.alias("titulo"), day.alias("publicado_em"), data.alias("dados"), _order())


def _rows(pages: DataFrame, schema: str, path: str) -> DataFrame:
    """Elements of the array at `path` of each JSON body, with their position."""
    return pages.select("fonte", "pagina", F.from_json("corpo", schema).alias("_d")).select("fonte", "pagina", F.posexplode(f"_d.{path}").alias("_i", "_r"))


def header_rows(body: Column) -> Column:
    """A JSON table with its header in the first row as an array of maps; blank rows and a resume key are left out."""
    table = F.from_json(body, "array<array<string>>")
    named = F.transform(F.slice(table, 2, F.greatest(F.size(table) - 1, F.lit(0))), lambda r: F.when(F.size(r) == F.size(table[0]), F.map_from_arrays(table[0], r)))
    return F.filter(named, lambda r: r.isNotNull())


def resume_key(body: Column) -> Column:
    """The key of the next page: a lone value after an empty last row, else null."""
    table = F.from_json(body, "array<array<string>>")
    n = F.size(table)
    return F.when((n >= 3) & (F.size(F.get(table, n - 2)) == 0) & (F.size(F.get(table, n - 1)) == 1), F.get(F.get(table, n - 1), F.lit(0)))


def wayback(pages: DataFrame, noise: str | None = None) -> DataFrame:
    rows = pages.select("fonte", "pagina", F.posexplode(header_rows(F.col("corpo"))).alias("_i", "_r"))
    original, stamp = F.col("_r")["original"], F.coalesce(F.col("_r")["timestamp"], F.lit(""))
    rows = rows.filter(original.isNotNull() & (original != ""))
    rows = rows.filter(~(is_noise(original) if noise is None else is_noise(original, noise)))
    snap = U.snapshot(stamp, original)
    return _refs(rows, original, snap, original, X.compact_day(stamp), {"original": original, "timestamp": stamp, "snapshot": snap})


_RSS = "channel struct<item: array<struct<title: string, link: string, guid: string, pubDate: string>>>"
_ATOM = "entry array<struct<title: string, id: string, published: string, updated: string, link: array<struct<_href: string, _rel: string>>>>"


def feed(pages: DataFrame, since: Column | None = None) -> DataFrame:
    """RSS 2.0 and Atom 1.0 entries; one without a link is skipped, one without a date passes the window."""
    body = F.regexp_replace("corpo", r'(<guid)[^>]*>', "$1>")
    both = pages.select("fonte", "pagina", F.from_xml(body, _RSS).alias("r"), F.from_xml(body, _ATOM).alias("a"))
    text = lambda c: F.nullif(F.trim(c), F.lit(""))
    rss = F.transform(F.coalesce("r.channel.item", F.array()), lambda x: F.struct(F.coalesce(text(x["guid"]), text(x["link"])).alias("id"), text(x["link"]).alias("url"), text(x["title"]).alias("title"), X.feed_day(x["pubDate"]).alias("day")))
    href = lambda x: F.get(F.filter(x["link"], lambda k: F.coalesce(k["_rel"], F.lit("alternate")) == "alternate"), F.lit(0))["_href"]
    atom = F.transform(F.coalesce("a.entry", F.array()), lambda x: F.struct(F.coalesce(text(x["id"]), text(href(x))).alias("id"), text(href(x)).alias("url"), text(x["title"]).alias("title"), X.feed_day(F.coalesce(x["published"], x["updated"])).alias("day")))
    rows = both.select("fonte", "pagina", F.posexplode(F.concat(rss, atom)).alias("_i", "_r")).filter("_r.url is not null")
    if since is not None:
        rows = rows.filter(F.col("_r.day").isNull() | (F.col("_r.day") >= since))
    return _refs(rows, F.col("_r.id"), F.col("_r.url"), F.col("_r.title"), F.col("_r.day"), {})


def gdelt(pages: DataFrame) -> DataFrame:
    rows = _rows(pages, "articles array<struct<url: string, title: string, seendate: string, domain: string, language: string, sourcecountry: string>>", "articles")
    r = F.col("_r")
    rows = rows.filter(F.coalesce(r["url"], F.lit("")) != "")
    return _refs(rows, r["url"], r["url"], r["title"], X.compact_day(r["seendate"]), {k: r[k] for k in ("domain", "language", "sourcecountry")})


def openalex(pages: DataFrame) -> DataFrame:
    """id, DOI else landing page else id as address; the abstract is rebuilt from its inverted index."""
    schema = """results array<struct<id: string, doi: string, display_name: string, publication_date: string, type: string,
      abstract_inverted_index: map<string, array<int>>, primary_location: struct<landing_page_url: string, source: struct<display_name: string>>, open_access: struct<oa_url: string>>>"""
    r = F.col("_r")
    rows = _rows(pages, schema, "results")
    empty = lambda c: F.nullif(c, F.lit(""))
    url = F.coalesce(empty(r["doi"]), empty(r["primary_location"]["landing_page_url"]), r["id"])
    extra = {"titulo": r["display_name"], "resumo": X.inverted_text(r["abstract_inverted_index"]), "tipo": r["type"], "veiculo": r["primary_location"]["source"]["display_name"], "acesso_aberto": r["open_access"]["oa_url"]}
    return _refs(rows, F.coalesce(r["id"], F.lit("None")), url, r["display_name"], X.iso_day(r["publication_date"]), extra)


def crossref(pages: DataFrame) -> DataFrame:
    """Rows with a DOI; ids in lower case, addresses as written; titles joined."""
    schema = """message struct<items: array<struct<DOI: string, title: array<string>, abstract: string, issued: struct<`date-parts`: array<array<int>>>, URL: string,
      `container-title`: array<string>, type: string>>>"""
    r = F.col("_r")
    rows = _rows(pages, schema, "message.items").filter(F.coalesce(r["DOI"], F.lit("")) != "")
    title = F.nullif(F.trim(X.joined(r["title"])), F.lit(""))
    extra = {"titulo": title, "resumo": X.strip_markup(F.coalesce(r["abstract"], F.lit(""))), "tipo": r["type"], "veiculo": X.joined(r["container-title"]), "pagina": r["URL"]}
    return _refs(rows, F.lower(r["DOI"]), F.concat(F.lit("https://doi.org/"), r["DOI"]), title, X.parts_day(F.get(r["issued"]["date-parts"], F.lit(0))), extra)


def archive_items(pages: DataFrame, details: str = "https://archive.org/details") -> DataFrame:
    """Items of an archive's search; fields are a value or a list, and the public date wins over the date."""
    rows = _rows(pages, "response struct<docs: array<struct<identifier: string, title: string, description: string, mediatype: string, date: string, publicdate: string>>>", "response.docs")
    r = F.col("_r")
    rows = rows.filter(F.coalesce(r["identifier"], F.lit("")) != "")
    # a list read as a string keeps its JSON form
    flat = lambda c: F.when(c.startswith("["), X.joined(F.from_json(c, "array<string>"))).otherwise(F.coalesce(c, F.lit("")))
    head = lambda c: F.when(c.startswith("["), F.get(F.from_json(c, "array<string>"), F.lit(0))).otherwise(c)
    title = F.nullif(F.trim(flat(r["title"])), F.lit(""))
    day = F.coalesce(X.iso_day(head(r["publicdate"])), X.iso_day(head(r["date"])))
    return _refs(rows, r["identifier"], F.concat(F.lit(details + "/"), r["identifier"]), title, day, {"titulo": title, "descricao": flat(r["description"]), "tipo": flat(r["mediatype"]), "data_original": flat(r["date"])})


def wikipedia(pages: DataFrame) -> DataFrame:
    """External links over http(s), each page address once over all titles; archived ones carry their snapshot."""
    schema = "query struct<pages: array<struct<title: string, extlinks: array<struct<url: string, `*`: string>>>>>"
    rows = _rows(pages, schema, "query.pages").select("fonte", "pagina", F.col("_i").alias("_p"), F.col("_r.title").alias("_t"), F.posexplode("_r.extlinks").alias("_k", "_r"))
    u = F.coalesce(F.nullif(F.col("_r")["url"], F.lit("")), F.col("_r")["*"])
    rows = rows.withColumn("_i", F.col("_p") * 1000 + F.col("_k")).filter(u.rlike("^https?://"))
    snap = F.when(U.unarchived(u) != u, u)
    refs = _refs(rows, U.normalized(u), u, F.lit(None).cast("string"), F.lit(None).cast("date"), {"via": F.col("_t"), "snapshot": snap})
    return first_wins(refs, ["fonte", "id_na_fonte"], "ord").select(*REFERENCE)


def curated(spark: SparkSession, path: str, source: str) -> DataFrame:
    """A CSV of url, titulo, publicado_em; blank addresses are skipped, bad dates null, no window applies."""
    raw = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True, schema="url string, titulo string, publicado_em string")
    rows = raw.filter(F.coalesce(F.trim("url"), F.lit("")) != "").select(F.lit(source).alias("fonte"), F.lit(0).alias("pagina"), F.monotonically_increasing_id().alias("_i"), F.struct(F.trim("url").alias("url"), F.nullif(F.trim("titulo"), F.lit("")).alias("titulo"), F.trim("publicado_em").alias("d")).alias("_r"))
    r = F.col("_r")
    return _refs(rows, U.normalized(r["url"]), r["url"], r["titulo"], X.iso_day(r["d"]), {})


def topic_links(pages: DataFrame, only_domain: Column | None = None) -> DataFrame:
    """Article links of topic pages (fonte, pagina, base, corpo): absolute, of the page's domain, each address once."""
    base = U.unarchived(F.col("base"))
    rows = pages.select("fonte", "pagina", base.alias("_b"), F.posexplode(anchors("corpo", base)).alias("_i", "_u"))
    link = U.unarchived(F.col("_u"))
    host = F.regexp_replace(F.lower(F.regexp_extract(link, r"^https?://([^/?#]*)", 1)), r"^www\.", "")
    home = U.registrable(F.split_part(U.domain(F.col("_b")), F.lit(":"), F.lit(1))) if only_domain is None else only_domain
    path = F.regexp_replace(F.regexp_extract(link, r"^https?://[^/?#]*([^?#]*)", 1), "^/+|/+$", "")
    keep = link.rlike("^https?://") & ((host == home) | F.endswith(host, F.concat(F.lit("."), home))) & (F.length(path) >= 8) & ~link.rlike(NAVIGATION) & (U.normalized(link) != U.normalized(F.col("_b")))
    rows = rows.filter(keep)
    refs = _refs(rows, U.normalized(link), F.split_part(link, F.lit("#"), F.lit(1)), F.lit(None).cast("string"), F.lit(None).cast("date"), {})
    return first_wins(refs, ["fonte", "id_na_fonte"], "ord").select(*REFERENCE)


PARSERS = {"wayback": wayback, "rss": feed, "gdelt": gdelt, "openalex": openalex, "crossref": crossref, "ia": archive_items, "wikipedia": wikipedia}
