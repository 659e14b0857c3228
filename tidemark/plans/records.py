"""Queries over addresses, references, runs, state, catalogue and estimates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.functions import url as U
from tidemark.operators import catalog, estimate, integrity, report, runs, slices, state
from tidemark.session import scratch, table
from tidemark.streaming import ingest

SINCE, TODAY = "2010-01-01", "2024-12-09"


def _items(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "itens")


def url_forms(spark: SparkSession, sf: str) -> DataFrame:
    u = F.col("url")
    urls = _items(spark, sf).select("url").filter("url is not null").distinct()
    return urls.select("url", U.normalized(u).alias("normal"), U.identity(u).alias("id"), U.domain(u).alias("dominio"), U.unarchived(u).alias("original"))


def domain_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = _items(spark, sf).filter("url is not null").select(U.domain(F.col("url")).alias("dominio"), U.identity(F.col("url")).alias("id"))
    return rows.groupBy("dominio").agg(F.count("*").alias("n"), F.countDistinct("id").alias("paginas"))


def registrable_domains(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "fontes").select("dominio", U.registrable(F.col("dominio")).alias("registravel"))


def noise_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _items(spark, sf).filter("url is not null").select("url").distinct().select("url", slices.is_noise(F.col("url")).alias("ruido"))


def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("snapshot")
    return _items(spark, sf).filter("snapshot is not null").select("ord", U.snapshot_stamp(s).alias("carimbo"), X.compact_day(U.snapshot_stamp(s)).alias("dia"), U.unarchived(s).alias("original"))


def small_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Redaction, file names, table cells, displayed titles and channels of run items."""
    i = _items(spark, sf)
    msg = F.concat(F.coalesce("erro", F.lit("")), F.lit(" ?api_key="), F.col("id_na_fonte"), F.lit("&q=1&token="), F.col("rodada"))
    return i.select("ord", X.redact(msg).alias("mensagem"), X.safe_name(F.col("fonte")).alias("arquivo"), X.cell(F.col("titulo")).alias("celula"), X.item_title(F.col("titulo"), F.col("url"), F.col("motivo")).alias("exibido"), X.channel(F.col("fonte")).alias("canal"), X.decade(F.col("publicado_em").cast("string")).alias("decada"))


def inverted_index(spark: SparkSession, sf: str) -> DataFrame:
    """Titles rebuilt from an index of word positions."""
    t = table(spark, sf, "openalex_listagem").filter("titulo is not null").select("ord", F.split("titulo", " ").alias("w"))
    at = F.transform(F.array_distinct("w"), lambda x: F.struct(x.alias("key"), F.filter(F.transform("w", lambda y, i: F.when(y == x, i)), lambda i: i.isNotNull()).alias("value")))
    return t.select("ord", X.inverted_text(F.map_from_entries(at)).alias("texto"))


def markup_strip(spark: SparkSession, sf: str) -> DataFrame:
    marked = F.concat(F.lit("<jats:p>"), F.replace("titulo", F.lit(" "), F.lit("</i>  <i>")), F.lit("</jats:p>"))
    return table(spark, sf, "openalex_listagem").filter("titulo is not null").select("ord", X.strip_markup(marked).alias("limpo"))


def dates_parsed(spark: SparkSession, sf: str) -> DataFrame:
    """Every date notation of the channels, written from one date and read back."""
    d = F.col("publicado_em")
    mail = F.concat(F.date_format(d, "EEE, dd MMM yyyy"), F.lit(" 23:30:00 -0300"))
    return (
        table(spark, sf, "openalex_listagem")
        .filter("publicado_em is not null")
        .select(
            "ord",
            X.feed_day(mail).alias("rfc822"),
            X.feed_day(F.concat(d.cast("string"), F.lit("T23:30:00-03:00"))).alias("rfc3339"),
            X.compact_day(F.date_format(d, "yyyyMMdd'T000000Z'")).alias("compacta"),
            X.iso_day(F.concat(d.cast("string"), F.lit("T00:00:00Z"))).alias("iso"),
            X.parts_day(F.array(F.year(d), F.month(d), F.lit(0))).alias("partes"),
            X.moment(d, 18).alias("momento"),
        )
    )


def stratum_lookup(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "fontes").select("fonte", "estrato")
    rows = _items(spark, sf).select("ord", "fonte").join(s, "fonte", "left")
    return rows.groupBy(F.coalesce("estrato", F.lit("geral")).alias("estrato")).agg(F.count("*").alias("n"))


def first_listed(spark: SparkSession, sf: str) -> DataFrame:
    return state.first_wins(_items(spark, sf).select("fonte", "id_na_fonte", "ord", "url"), ["fonte", "id_na_fonte"], "ord")


def last_hash(spark: SparkSession, sf: str) -> DataFrame:
    rows = _items(spark, sf).filter("hash_texto is not null")
    return state.last_wins(rows, ["fonte", "id_na_fonte"], "ord", "hash_texto")


_LAST = "20241125T000000Z"


def _before(items: DataFrame) -> DataFrame:
    return items.filter(F.col("rodada") < _LAST)


def to_fetch(spark: SparkSession, sf: str) -> DataFrame:
    """What the latest runs would fetch: listed then, or failed before and pending, and never settled before."""
    i = _items(spark, sf)
    cols = ["fonte", "id_na_fonte", "url", "ord"]
    seen = _before(i).filter(F.col("situacao").isin(state.DONE, state.BLOCKED)).select("fonte", "id_na_fonte")
    pending = _before(i).filter(F.col("situacao").isin(state.FAILED, state.REJECTED)).select(*cols)
    return state.to_fetch(i.filter(F.col("rodada") >= _LAST).select(*cols), pending, seen)


def state_seen(spark: SparkSession, sf: str) -> DataFrame:
    i = _items(spark, sf)
    old = spark.createDataFrame([], "fonte string, id_na_fonte string, hash_texto string")
    return state.next_seen(state.next_seen(old, _before(i)), i.filter(F.col("rodada") >= _LAST))


def state_pending(spark: SparkSession, sf: str) -> DataFrame:
    none = spark.createDataFrame([], "fonte string, id_na_fonte string, url string, extra map<string,string>, motivo string, tentativas int")
    items = _items(spark, sf).withColumn("extra", F.create_map(F.lit("titulo"), F.col("titulo")))
    return state.next_pending(state.next_pending(none, _before(items)), items.filter(F.col("rodada") >= _LAST)).select("fonte", "id_na_fonte", "url", "motivo", "tentativas")


def window_starts(spark: SparkSession, sf: str) -> DataFrame:
    last = _items(spark, sf).groupBy("fonte").agg(F.max(F.to_date("capturado_em")).alias("ultima"))
    j = table(spark, sf, "fontes").join(last, "fonte", "left")
    start = state.window_start(F.lit(None).cast("date"), F.col("ultima"), F.col("margem_dias"), F.lit(None).cast("date"), F.lit(TODAY).cast("date"))
    mark = state.next_watermark(F.col("ultima"), F.col("canal") == "gdelt", F.col("canal") == "wayback", F.lit(TODAY).cast("date"))
    return j.select("fonte", start.alias("inicio"), mark.alias("marca"))


def slice_plan(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "fontes").filter("canal = 'wayback'").select("fonte", F.col("dominio").alias("prefixo"))
    return slices.plan(p, F.lit("2003-05-20").cast("date"), F.lit(TODAY).cast("date"))


def slice_pending(spark: SparkSession, sf: str) -> DataFrame:
    done = _items(spark, sf).join(table(spark, sf, "fontes").filter("canal = 'wayback'").select("fonte", F.col("dominio").alias("prefixo")), "fonte")
    done = done.filter("publicado_em is not null").select("fonte", "prefixo", F.year("publicado_em").alias("ano")).filter("ano < 2012")
    return slices.remaining(slice_plan(spark, sf), done, 5)


def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return runs.counts(_items(spark, sf))


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    i = _items(spark, sf)
    return runs.summary(i, i.filter("situacao = 'falha_captura' and erro like 'HTTP 5%'"))


def report_sections(spark: SparkSession, sf: str) -> DataFrame:
    return runs.buckets(_items(spark, sf))


def corpus_paths(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documento").select("fonte", "hash_texto", "ord", integrity.intact(F.col("texto")).alias("integro"))
    return runs.corpus(d, "integro")


def _seen(spark: SparkSession, sf: str) -> DataFrame:
    return estimate.sightings(_items(spark, sf))


def _obs(spark: SparkSession, sf: str, since: str | None = None) -> DataFrame:
    return estimate.observed(_seen(spark, sf), table(spark, sf, "fontes"), 2, F.lit(since).cast("date") if since else None)


def sighting_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _seen(spark, sf)


def run_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The report of every run, one line for each item, by section."""
    return runs.report_rows(_items(spark, sf))


def run_records(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each record sink, stamped with the lexicon."""
    sinks = runs.records(_items(spark, sf), "ilha", "2024-07-15")
    each = [df.select(F.lit(k).alias("arquivo"), "rodada", "ord", "lexico_id", F.col("lexico_versao").alias("versao")) for k, df in sinks.items()]
    out = each[0].unionByName(each[1]).unionByName(each[2])
    return out.groupBy("arquivo", "rodada", "lexico_id", "versao").agg(F.count("*").alias("n"), F.max("ord").alias("ultima"))


def dates_refused(spark: SparkSession, sf: str) -> DataFrame:
    """Notations of days that don't exist, and of none at all."""
    y = F.year("publicado_em").cast("string")
    rows = table(spark, sf, "openalex_listagem").filter("publicado_em is not null")
    return rows.select(
        "ord",
        X.feed_day(F.concat(F.lit("Sun, 31 Feb "), y, F.lit(" 23:30:00 -0300"))).alias("rfc822"),
        X.feed_day(F.concat(y, F.lit("-02-31T23:30:00Z"))).alias("rfc3339"),
        X.compact_day(F.concat(y, F.lit("1301T000000Z"))).alias("compacta"),
        X.compact_day(F.concat(y, F.lit("-1-2"))).alias("sem_digitos"),
        X.iso_day(F.concat(y, F.lit("-13-01"))).alias("iso"),
        X.parts_day(F.array(F.year("publicado_em"), F.lit(2), F.lit(30))).alias("partes"),
        X.parts_day(F.array(F.lit(None).cast("int"), F.lit(2), F.lit(3))).alias("sem_ano"),
        X.parts_day(F.array(F.year("publicado_em"))).alias("so_ano"),
    )


def inverted_index_clash(spark: SparkSession, sf: str) -> DataFrame:
    """Titles rebuilt from an index in which a last entry claims the first and the last position as well."""
    t = table(spark, sf, "openalex_listagem").filter("titulo is not null").select("ord", F.split("titulo", " ").alias("w"))
    at = F.transform(F.array_distinct("w"), lambda x: F.struct(x.alias("key"), F.filter(F.transform("w", lambda y, i: F.when(y == x, i)), lambda i: i.isNotNull()).alias("value")))
    late = F.array(F.struct(F.lit("\u25a0").alias("key"), F.array(F.lit(0), F.size("w") - 1).alias("value")))
    return t.select("ord", X.inverted_text(F.map_from_entries(F.concat(at, late))).alias("texto"))


def stream_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Captures by day and source, counted by the streaming window aggregate as far as the files go."""
    root = scratch(spark, "windows")
    schema = spark.read.parquet(f"{sf}/itens.parquet").select("fonte", "capturado_em").schema
    ingest.count_windows(spark, f"{sf}/itens.parquet*", root, schema)
    got = spark.read.parquet(f"{root}/counts")
    return got.select(F.to_date("janela.start").alias("inicio"), "fonte", "n")


def sighting_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _seen(spark, sf).groupBy("rodada", "canal").agg(F.count("*").alias("n"), F.countDistinct("id").alias("paginas"))


def channel_units(spark: SparkSession, sf: str) -> DataFrame:
    return estimate.per_channel(_obs(spark, sf))


def unit_frequencies(spark: SparkSession, sf: str) -> DataFrame:
    return estimate.frequencies(_obs(spark, sf))


def coverage(spark: SparkSession, sf: str) -> DataFrame:
    return estimate.coverage(_obs(spark, sf))


def coverage_aligned(spark: SparkSession, sf: str) -> DataFrame:
    return estimate.coverage(_obs(spark, sf, SINCE), aligned=True)


def channel_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return estimate.pairs(_obs(spark, sf))


def accumulation_curve(spark: SparkSession, sf: str) -> DataFrame:
    return estimate.curve(_obs(spark, sf), _items(spark, sf).select("rodada").distinct())


def catalog_entries(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.entries(_items(spark, sf), table(spark, sf, "fontes"))


def catalog_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Entries of all runs appended to what the catalogue held before September 2024."""
    old = table(spark, sf, "catalogo").filter("primeira_rodada < '20240901'")
    return catalog.upsert(old, catalog_entries(spark, sf)).select("ord", "id", "hash_texto", "primeira_rodada")


def catalog_complete(spark: SparkSession, sf: str) -> DataFrame:
    captures = _items(spark, sf).filter("snapshot is not null").select(U.identity(F.col("snapshot")).alias("id"), U.snapshot_stamp(F.col("snapshot")).alias("carimbo"))
    return catalog.complete(table(spark, sf, "catalogo"), captures).select("id", "snapshot", "capturado_em", "preenchido")


def catalog_migrate(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "catalogo")
    return catalog.migrate(c.select(F.lit("").alias("id"), F.when(c.snapshot != "", c.snapshot).otherwise(c.url).alias("url"), "identificadores")).select("id", "url", "dominio", "snapshot", "titulo", "identificadores")


def catalog_search(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.search(table(spark, sf, "catalogo"), "placa", "imprensa", "lugar", decade="2010").select("id", "titulo")


def catalog_newest(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.newest(table(spark, sf, "catalogo"), page=1).select("id", "publicado_em", "capturado_em")


def catalog_tiles(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.tiles(table(spark, sf, "catalogo"))


def catalog_facets(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.facets(table(spark, sf, "catalogo"))


def stream_refs(spark: SparkSession, sf: str) -> DataFrame:
    """Listed references taken from files by the streaming ingest, each once."""
    root = scratch(spark, "stream")
    schema = spark.read.parquet(f"{sf}/itens.parquet").select("fonte", "id_na_fonte", "url", "ord").schema
    ingest.ingest(spark, f"{sf}/itens.parquet*", root, schema)
    return spark.read.schema(schema).parquet(f"{root}/refs").select("fonte", "id_na_fonte", "url", "ord")


def report_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The Markdown coverage report, line by line."""
    obs = _obs(spark, sf).persist()
    text = report.coverage_report(estimate.coverage(obs), estimate.per_channel(obs), estimate.pairs(obs), estimate.curve(obs, _items(spark, sf).select("rodada").distinct()))
    obs.unpersist()
    lines = [(i, x) for i, x in enumerate(text.split("\n"))]  # as many as strata, channels and pairs
    return spark.createDataFrame(lines, "linha int, texto string")


QUERIES = {
    f.__name__: f
    for f in (
        stream_refs, stream_windows, report_lines, sighting_rows, run_lines, run_records, dates_refused, inverted_index_clash,
        url_forms, domain_counts, registrable_domains, noise_filter, snapshots, small_texts, inverted_index, markup_strip, dates_parsed, stratum_lookup, first_listed, last_hash, to_fetch, state_seen,
        state_pending, window_starts, slice_plan, slice_pending, status_counts, run_summary, report_sections, corpus_paths, sighting_counts, channel_units, unit_frequencies, coverage, coverage_aligned,
        channel_pairs, accumulation_curve, catalog_entries, catalog_upsert, catalog_complete, catalog_migrate, catalog_search, catalog_newest, catalog_tiles, catalog_facets,
    )
}

_HOSTS = "|".join(h.replace(".", "\\.") for h in U.ARCHIVE_HOSTS)


def _unarchived(u: str) -> str:
    m = f"regexp_extract(trim({u}), '^https?://(?:{_HOSTS})/web/\\d+[a-z_]*/(.+)$', 1)"
    return f"CASE WHEN {m} <> '' THEN {m} ELSE {u} END"


def _norm(u: str) -> str:
    """The normal form as one expression; query values in these tables need no decoding."""
    t = f"({_unarchived(u)})"
    full = f"(CASE WHEN contains({t}, '://') THEN {t} ELSE 'http://' || {t} END)"
    rest = f"regexp_replace(regexp_replace({full}, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.\\-]*:', '')"
    host = f"regexp_replace(regexp_replace(lower(regexp_extract({rest}, '^//([^/?]*)', 1)), '^www\\.', ''), ':(80|443)$', '')"
    path = f"regexp_replace(regexp_replace(regexp_replace({rest}, '^//[^/?]*', ''), '\\?.*$', ''), '/+$', '')"
    keys = "|".join(k for k in U.TRACKING_KEYS)
    keep = f"list_sort(list_filter(string_split(regexp_extract({rest}, '\\?(.*)$', 1), '&'), lambda p: regexp_matches(p, '^[^=]*=.') AND NOT regexp_matches(lower(p), '^({'|'.join(U.TRACKING_PREFIXES)}|({keys})=)')))"
    return f"{host} || CASE WHEN {path} = '' THEN '/' ELSE {path} END || CASE WHEN len({keep}) > 0 THEN '?' || array_to_string({keep}, '&') ELSE '' END"


def page_sql(u: str) -> str:
    return f"sha256({_norm(u)})[1:16]"


def _stamp(s: str) -> str:
    return f"nullif(regexp_replace(regexp_extract({s}, '/web/([^/]*)/', 1), '[a-z_]+$', ''), '')"


def _first(u: str) -> str:
    return f"split_part({_norm(u)}, '/', 1)"


_SEEN = f"""
WITH seen AS (SELECT ord, {page_sql('url')} AS id, split_part(fonte, ':', 1) AS canal, fonte, rodada, nivel, publicado_em, hash_texto FROM itens
  WHERE situacao = 'triado' AND coalesce(nivel, 0) >= 2 AND url IS NOT NULL),
unit AS (SELECT id, arg_max(coalesce(nullif(hash_texto, ''), id), ord) AS unidade FROM seen GROUP BY 1),
obs AS (SELECT DISTINCT coalesce(f.estrato, 'geral') AS estrato, canal, rodada, unidade, publicado_em FROM seen JOIN unit USING (id) LEFT JOIN (SELECT fonte, estrato FROM fontes) f USING (fonte)),
"""
_CHAO = """
comp AS (SELECT * FROM cells WHERE {keep}),
fk AS (SELECT estrato, k, count(*) AS n FROM (SELECT estrato, unidade, count(*) AS k FROM comp GROUP BY 1, 2) GROUP BY 1, 2),
f AS (SELECT estrato, sum(n) AS s, coalesce(sum(n) FILTER (k = 1), 0) AS f1, coalesce(sum(n) FILTER (k = 2), 0) AS f2 FROM fk GROUP BY 1),
ch AS (SELECT estrato, count(DISTINCT canal) AS canais FROM comp GROUP BY 1),
tot AS (SELECT estrato, count(DISTINCT unidade) AS observadas FROM cells GROUP BY 1),
r AS (SELECT estrato, s, observadas, coalesce(canais, 0) AS canais, coalesce(f1, 0)::BIGINT AS f1, coalesce(f2, 0)::BIGINT AS f2,
  CASE WHEN canais >= 2 THEN round(CASE WHEN f2 > 0 THEN s + f1::DOUBLE * f1 / (2 * f2) ELSE s + f1::DOUBLE * (f1 - 1) / 2 END, 6) END AS chao
  FROM tot LEFT JOIN ch USING (estrato) LEFT JOIN f USING (estrato))
SELECT estrato, observadas, canais, f1, f2, chao, CASE WHEN chao > 0 THEN round(s / chao, 6) END AS cobertura FROM r"""
_CELLS = "cells AS (SELECT DISTINCT estrato, canal, unidade FROM obs),"
_ENTRIES = f"""SELECT ord, {page_sql('url')} AS id, {_unarchived('url')} AS url, {_first('url')} AS dominio, coalesce(f.estrato, 'geral') AS estrato, trim(replace(coalesce(titulo, ''), chr(10), ' ')) AS titulo,
  coalesce(publicado_em::VARCHAR, '') AS publicado_em, coalesce({_stamp('snapshot')}, '') AS capturado_em, coalesce(snapshot, '') AS snapshot, coalesce(hash_texto, '') AS hash_texto,
  CASE WHEN nivel > 0 THEN nivel::VARCHAR ELSE '' END AS nivel, coalesce(array_to_string(chaves, ';'), '') AS identificadores, coalesce(array_to_string(categorias, ';'), '') AS categorias,
  coalesce(rodada, '') AS primeira_rodada, coalesce(lexico_versao, '') AS lexico_versao
  FROM itens LEFT JOIN (SELECT fonte, estrato FROM fontes) f USING (fonte) WHERE situacao = 'triado' AND coalesce(nivel, 0) >= 3 AND url IS NOT NULL"""
_DAY = "coalesce(nullif(publicado_em, ''), nullif(capturado_em, ''))"
_DECADE = f"CASE WHEN regexp_matches({_DAY}, '^\\d{{4}}') THEN {_DAY}[1:3] || '0' END"
_PLAN = f"""SELECT fonte, dominio AS prefixo, ano::INT AS ano, CASE WHEN ano = 2003 THEN DATE '2003-05-20' ELSE make_date(ano, 1, 1) END AS inicio,
  CASE WHEN ano < 2024 THEN make_date(ano, 12, 31) END AS fim FROM fontes, range(2003, 2025) t(ano) WHERE canal = 'wayback'"""
_NOISE = slices.NOISE.replace("'", "''")
_SECTION = "CASE WHEN situacao = 'triado' THEN CASE nivel WHEN 3 THEN 'aceitos' WHEN 2 THEN 'juizo' WHEN 1 THEN 'nivel1' WHEN 0 THEN 'nivel0' END WHEN situacao IN ('falha_captura', 'reprovado_sentinela') THEN 'falhas' WHEN situacao = 'bloqueado_robots' THEN 'robots' END"
_CELL = "trim(replace(replace(coalesce({}, ''), '|', '\\|'), chr(10), ' '))"
_SPLIT = "rodada {op} '" + _LAST + "'"

SQL = {
    "url_forms": f"SELECT url, {_norm('url')} AS normal, {page_sql('url')} AS id, {_first('url')} AS dominio, {_unarchived('url')} AS original FROM (SELECT DISTINCT url FROM itens WHERE url IS NOT NULL)",
    "domain_counts": f"SELECT {_first('url')} AS dominio, count(*) AS n, count(DISTINCT {page_sql('url')}) AS paginas FROM itens WHERE url IS NOT NULL GROUP BY 1",
    "registrable_domains": "SELECT dominio, array_to_string(CASE WHEN len(p) > 2 AND length(p[-2]) <= 3 THEN p[-3:] ELSE p[-2:] END, '.') AS registravel FROM (SELECT dominio, string_split(dominio, '.') AS p FROM fontes)",
    "noise_filter": f"SELECT url, regexp_matches(url, '{_NOISE}') AS ruido FROM (SELECT DISTINCT url FROM itens WHERE url IS NOT NULL)",
    "snapshots": f"SELECT ord, {_stamp('snapshot')} AS carimbo, CASE WHEN regexp_matches({_stamp('snapshot')}, '^\\d{{8}}') THEN try_strptime({_stamp('snapshot')}[1:8], '%Y%m%d')::DATE END AS dia, {_unarchived('snapshot')} AS original FROM itens WHERE snapshot IS NOT NULL",
    "small_texts": """SELECT ord, regexp_replace(coalesce(erro, '') || ' ?api_key=' || id_na_fonte || '&q=1&token=' || rodada, '((?:api[_-]?key|apikey|key|token|access[_-]?token|secret|password|senha|mailto)=)[^&#\\s]+', '\\1<redigido>', 'gi') AS mensagem,
  coalesce(nullif(regexp_replace(regexp_replace(fonte, '[^A-Za-z0-9._\\-]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), '_') AS arquivo,
  trim(replace(replace(coalesce(titulo, ''), '|', '\\|'), chr(10), ' ')) AS celula,
  CASE WHEN t IS NOT NULL AND t <> url AND NOT regexp_matches(t, '^(https?://|www\\.)\\S+$') THEN t ELSE coalesce(nullif(trim(motivo), ''), t) END AS exibido,
  split_part(fonte, ':', 1) AS canal, CASE WHEN publicado_em IS NOT NULL THEN (publicado_em::VARCHAR)[1:3] || '0' END AS decada FROM (SELECT *, nullif(trim(titulo), '') AS t FROM itens)""",
    "inverted_index": "SELECT ord, titulo AS texto FROM openalex_listagem WHERE titulo IS NOT NULL",
    "markup_strip": "SELECT ord, trim(regexp_replace(titulo, '\\s+', ' ', 'g')) AS limpo FROM openalex_listagem WHERE titulo IS NOT NULL",
    "dates_parsed": "SELECT ord, publicado_em AS rfc822, publicado_em AS rfc3339, publicado_em AS compacta, publicado_em AS iso, date_trunc('month', publicado_em)::DATE AS partes, strftime(publicado_em, '%Y%m%d') || '180000' AS momento FROM openalex_listagem WHERE publicado_em IS NOT NULL",
    "stratum_lookup": "SELECT coalesce(estrato, 'geral') AS estrato, count(*) AS n FROM itens LEFT JOIN (SELECT fonte, estrato FROM fontes) USING (fonte) GROUP BY 1",
    "first_listed": "SELECT fonte, id_na_fonte, min(ord) AS ord, arg_min(url, ord) AS url FROM itens GROUP BY 1, 2",
    "stream_refs": "SELECT fonte, id_na_fonte, arg_min(url, ord) AS url, min(ord) AS ord FROM itens GROUP BY 1, 2",
    "last_hash": "SELECT fonte, id_na_fonte, arg_max(hash_texto, ord) AS hash_texto FROM itens WHERE hash_texto IS NOT NULL GROUP BY 1, 2",
    "to_fetch": f"""WITH seen AS (SELECT fonte, id_na_fonte FROM itens WHERE {_SPLIT.format(op='<')} AND situacao IN ('triado', 'bloqueado_robots')),
refs AS (SELECT fonte, id_na_fonte, url, ord, 0 AS o FROM itens WHERE {_SPLIT.format(op='>=')} UNION ALL
  SELECT fonte, id_na_fonte, url, ord, 1 FROM itens WHERE {_SPLIT.format(op='<')} AND situacao IN ('falha_captura', 'reprovado_sentinela'))
SELECT fonte, id_na_fonte, url, ord FROM refs ANTI JOIN seen USING (fonte, id_na_fonte) QUALIFY row_number() OVER (PARTITION BY fonte, id_na_fonte ORDER BY o, ord) = 1""",
    "state_seen": """SELECT fonte, id_na_fonte, arg_max(h, (rodada >= '20241125T000000Z')::INT * 1000000000000 + ord) AS hash_texto FROM (
  SELECT *, CASE WHEN situacao = 'bloqueado_robots' THEN '' ELSE coalesce(hash_texto, '') END AS h FROM itens WHERE situacao IN ('triado', 'bloqueado_robots')) GROUP BY 1, 2""",
    "state_pending": f"""WITH runs AS (SELECT *, CASE WHEN {_SPLIT.format(op='<')} THEN 1 ELSE 2 END AS r FROM itens),
l AS (SELECT fonte, id_na_fonte, r, arg_max(situacao, ord) AS s, arg_max(url, ord) AS url FROM runs GROUP BY 1, 2, 3),
w AS (SELECT k.fonte, k.id_na_fonte, a.s AS s1, a.url AS u1, b.s AS s2, b.url AS u2 FROM (SELECT DISTINCT fonte, id_na_fonte FROM l) k
  LEFT JOIN (SELECT * FROM l WHERE r = 1) a USING (fonte, id_na_fonte) LEFT JOIN (SELECT * FROM l WHERE r = 2) b USING (fonte, id_na_fonte)),
p AS (SELECT *, coalesce(s1 IN ('falha_captura', 'reprovado_sentinela'), false) AS f1, coalesce(s2 IN ('falha_captura', 'reprovado_sentinela'), false) AS f2 FROM w)
SELECT fonte, id_na_fonte, CASE WHEN f2 THEN u2 ELSE u1 END AS url, CASE WHEN f2 THEN s2 ELSE s1 END AS motivo, (f1::INT + f2::INT)::INT AS tentativas FROM p WHERE f2 OR (s2 IS NULL AND f1)""",
    "window_starts": """SELECT fonte, coalesce(ultima - margem_dias, DATE '2024-12-09' - 7)::DATE AS inicio, CASE WHEN coalesce(canal = 'gdelt', false) OR coalesce(canal = 'wayback', false) THEN ultima ELSE DATE '2024-12-09' END AS marca
FROM fontes LEFT JOIN (SELECT fonte, max((capturado_em AT TIME ZONE 'UTC')::DATE) AS ultima FROM itens GROUP BY 1) USING (fonte)""",
    "slice_plan": _PLAN,
    "slice_pending": f"""WITH plan AS ({_PLAN}), done AS (SELECT DISTINCT i.fonte, f.dominio AS prefixo, year(publicado_em)::INT AS ano FROM itens i JOIN fontes f USING (fonte) WHERE canal = 'wayback' AND publicado_em IS NOT NULL AND year(publicado_em) < 2012)
SELECT fonte, prefixo, ano, inicio, fim FROM plan ANTI JOIN done USING (fonte, prefixo, ano) QUALIFY row_number() OVER (PARTITION BY fonte ORDER BY prefixo, ano) <= 5""",
    "status_counts": "SELECT rodada, 'situacao' AS grupo, situacao AS valor, count(*) AS n FROM itens WHERE situacao IS NOT NULL GROUP BY ALL UNION ALL SELECT rodada, 'motivo', motivo, count(*) FROM itens WHERE motivo IS NOT NULL GROUP BY ALL",
    "run_summary": """SELECT rodada, count(*) AS itens, coalesce(bool_or(nivel >= 2), false) AS pede_leitura,
  CASE WHEN count(*) FILTER (situacao = 'falha_captura' AND erro LIKE 'HTTP 5%') > 0 THEN 2 WHEN coalesce(bool_or(nivel >= 2), false) THEN 3 ELSE 0 END AS codigo FROM itens GROUP BY 1""",
    "report_sections": f"SELECT rodada, {_SECTION} AS secao, count(*) AS n FROM itens WHERE {_SECTION} IS NOT NULL GROUP BY ALL",
    "run_lines": f"""SELECT rodada, {_SECTION} AS secao, ord, '* [' || coalesce(nullif(substring({_CELL.format('titulo')}, 1, 120), ''), id_na_fonte) || '](' || coalesce(url, '') || '), ' || fonte
  || CASE WHEN situacao = 'triado' THEN coalesce(' — nível ' || nivel || ', ' || motivo || CASE WHEN len(chaves) > 0 THEN ': ' || array_to_string(chaves, ', ') ELSE '' END, '') WHEN {_CELL.format('erro')} <> '' THEN ' — ' || substring({_CELL.format('erro')}, 1, 200) ELSE '' END
  || CASE WHEN coalesce(snapshot, '') <> '' THEN ' — [arquivado](' || snapshot || ')' ELSE '' END AS linha FROM itens WHERE {_SECTION} IS NOT NULL""",
    "run_records": """SELECT arquivo, rodada, 'ilha' AS lexico_id, '2024-07-15' AS versao, count(*) AS n, max(ord) AS ultima FROM (SELECT 'itens' AS arquivo, rodada, ord FROM itens
  UNION ALL SELECT CASE nivel WHEN 3 THEN 'aceitos' ELSE 'pede-juizo' END, rodada, ord FROM itens WHERE situacao = 'triado' AND nivel IN (2, 3)) GROUP BY ALL""",
    "sighting_rows": f"""SELECT ord, {page_sql('url')} AS id, split_part(fonte, ':', 1) AS canal, fonte, rodada, nivel, publicado_em, hash_texto, {_unarchived('url')} AS url FROM itens
  WHERE situacao = 'triado' AND coalesce(nivel, 0) >= 2 AND url IS NOT NULL""",
    "stream_windows": "SELECT (capturado_em AT TIME ZONE 'UTC')::DATE AS inicio, fonte, count(*) AS n FROM itens WHERE capturado_em IS NOT NULL GROUP BY ALL",
    "dates_refused": "SELECT ord, NULL::DATE AS rfc822, NULL::DATE AS rfc3339, NULL::DATE AS compacta, NULL::DATE AS sem_digitos, NULL::DATE AS iso, NULL::DATE AS partes, NULL::DATE AS sem_ano, make_date(year(publicado_em), 1, 1) AS so_ano FROM openalex_listagem WHERE publicado_em IS NOT NULL",
    "inverted_index_clash": "SELECT ord, CASE WHEN len(w) = 1 THEN '■' ELSE array_to_string(list_concat(['■'], w[2:len(w) - 1], ['■']), ' ') END AS texto FROM (SELECT ord, string_split(titulo, ' ') AS w FROM openalex_listagem WHERE titulo IS NOT NULL)",
    "catalog_upsert": f"""WITH RECURSIVE e AS MATERIALIZED (SELECT ord, id, hash_texto, primeira_rodada, row_number() OVER (ORDER BY ord) AS k FROM ({_ENTRIES})
  WHERE id NOT IN (SELECT id FROM catalogo WHERE primeira_rodada < '20240901') AND (hash_texto = '' OR hash_texto NOT IN (SELECT hash_texto FROM catalogo WHERE primeira_rodada < '20240901'))),
r AS (SELECT 0::BIGINT AS k, []::VARCHAR[] AS ids, []::VARCHAR[] AS hs, NULL::BIGINT AS ord UNION ALL
  SELECT k, CASE WHEN ok THEN list_append(ids, id) ELSE ids END, CASE WHEN ok AND h <> '' THEN list_append(hs, h) ELSE hs END, CASE WHEN ok THEN o END
  FROM (SELECT e.k, r.ids, r.hs, e.id, e.hash_texto AS h, e.ord AS o, NOT list_contains(r.ids, e.id) AND (e.hash_texto = '' OR NOT list_contains(r.hs, e.hash_texto)) AS ok FROM r JOIN e ON e.k = r.k + 1))
SELECT ord, id, hash_texto, primeira_rodada FROM e WHERE ord IN (SELECT ord FROM r WHERE ord IS NOT NULL)""",
    "corpus_paths": "SELECT fonte, hash_texto, coalesce(nullif(regexp_replace(regexp_replace(fonte, '[^A-Za-z0-9._\\-]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), '_') || '/' || hash_texto || '.json' AS caminho, max(ord) AS ord FROM documento WHERE coalesce(length(texto) >= 400 AND (length(texto) >= 2500 OR NOT ("
    + " OR ".join("contains(lower(substring(texto, 1, 300)), '" + m.replace("'", "''") + "')" for m in integrity.ERROR_MARKS)
    + ")), false) GROUP BY 1, 2",
    "sighting_counts": f"{_SEEN.rstrip().rstrip(',')} SELECT rodada, canal, count(*) AS n, count(DISTINCT id) AS paginas FROM seen GROUP BY ALL",
    "channel_units": f"""{_SEEN}{_CELLS} alone AS (SELECT estrato, min(canal) AS canal FROM cells GROUP BY estrato, unidade HAVING count(*) = 1)
SELECT c.estrato, c.canal, c.unidades, coalesce(a.exclusivas, 0) AS exclusivas FROM (SELECT estrato, canal, count(*) AS unidades FROM cells GROUP BY 1, 2) c LEFT JOIN (SELECT estrato, canal, count(*) AS exclusivas FROM alone GROUP BY 1, 2) a USING (estrato, canal)""",
    "unit_frequencies": f"{_SEEN}{_CELLS.rstrip(',')} SELECT estrato, k, count(*) AS n FROM (SELECT estrato, unidade, count(*) AS k FROM cells WHERE canal <> 'gdelt' GROUP BY 1, 2) GROUP BY 1, 2",
    "coverage": f"{_SEEN}{_CELLS}{_CHAO.format(keep=chr(39).join(['canal <> ', 'gdelt', '']))}",
    "coverage_aligned": f"{_SEEN}cells AS (SELECT DISTINCT estrato, canal, unidade FROM obs WHERE publicado_em >= DATE '{SINCE}'),{_CHAO.format(keep='true')}",
    "channel_pairs": f"""{_SEEN}{_CELLS} sz AS (SELECT estrato, canal, count(*) AS n FROM cells GROUP BY 1, 2),
ov AS (SELECT x.estrato, x.canal AS a, y.canal AS b, count(*) AS m FROM cells x JOIN cells y ON x.estrato = y.estrato AND x.unidade = y.unidade AND x.canal < y.canal GROUP BY 1, 2, 3),
p AS (SELECT l.estrato, l.canal AS a, r.canal AS b, l.n AS n1, r.n AS n2, coalesce(ov.m, 0) AS m FROM sz l JOIN sz r ON l.estrato = r.estrato AND l.canal < r.canal LEFT JOIN ov ON ov.estrato = l.estrato AND ov.a = l.canal AND ov.b = r.canal),
e AS (SELECT *, (n1 + 1)::DOUBLE * (n2 + 1) / (m + 1) - 1 AS e, 1.96 * sqrt((n1 + 1)::DOUBLE * (n2 + 1) * (n1 - m) * (n2 - m) / ((m + 1)::DOUBLE * (m + 1) * (m + 2))) AS d FROM p)
SELECT estrato, a, b, n1, n2, m, round(e, 6) AS chapman, round(greatest((n1 + n2 - m)::DOUBLE, e - d), 6) AS baixo, round(e + d, 6) AS alto, NOT (a = 'gdelt' OR b = 'gdelt') AS comparavel FROM e""",
    "accumulation_curve": f"""{_SEEN}fst AS (SELECT estrato, unidade, min(rodada) AS rodada FROM obs GROUP BY 1, 2), nw AS (SELECT estrato, rodada, count(*) AS n FROM fst GROUP BY 1, 2),
grid AS (SELECT s.estrato, r.rodada FROM (SELECT estrato, min(rodada) AS f FROM nw GROUP BY 1) s JOIN (SELECT DISTINCT rodada FROM itens) r ON r.rodada >= s.f)
SELECT estrato, rodada, coalesce(n, 0) AS novas, (sum(coalesce(n, 0)) OVER (PARTITION BY estrato ORDER BY rodada))::BIGINT AS total FROM grid LEFT JOIN nw USING (estrato, rodada)""",
    "catalog_entries": _ENTRIES,
    "catalog_complete": f"""WITH c AS (SELECT {page_sql('snapshot')} AS id, max({_stamp('snapshot')}) AS s FROM itens WHERE snapshot IS NOT NULL GROUP BY 1)
SELECT id, CASE WHEN f THEN 'https://web.archive.org/web/' || s || 'id_/' || url ELSE snapshot END AS snapshot, CASE WHEN f THEN s ELSE capturado_em END AS capturado_em, f AS preenchido
FROM (SELECT *, coalesce(snapshot, '') = '' AND s IS NOT NULL AS f FROM catalogo LEFT JOIN c USING (id))""",
    "catalog_migrate": f"SELECT {page_sql('u')} AS id, {_unarchived('u')} AS url, {_first('u')} AS dominio, CASE WHEN {_unarchived('u')} <> u THEN u ELSE '' END AS snapshot, '' AS titulo, identificadores FROM (SELECT CASE WHEN snapshot <> '' THEN snapshot ELSE url END AS u, identificadores FROM catalogo)",
    "catalog_search": f"SELECT id, titulo FROM catalogo WHERE contains(lower(coalesce(nullif(trim(titulo), ''), url)), 'placa') AND estrato = 'imprensa' AND list_contains(string_split(categorias, ';'), 'lugar') AND {_DECADE} = '2010'",
    "catalog_newest": f"SELECT id, publicado_em, capturado_em FROM catalogo ORDER BY coalesce({_DAY}, '') DESC, id LIMIT 100 OFFSET 100",
    "catalog_tiles": f"SELECT count(*) AS documentos, count(DISTINCT dominio) AS dominios, count(*) FILTER (coalesce(snapshot, '') <> '') AS com_snapshot, count(DISTINCT {_DECADE}) AS decadas FROM catalogo",
    "catalog_facets": f"""SELECT faceta, valor, count(*) AS n FROM (SELECT 'estrato' AS faceta, estrato AS valor FROM catalogo UNION ALL SELECT 'categoria', unnest(string_split(categorias, ';')) FROM catalogo
  UNION ALL SELECT 'dominio', dominio FROM catalogo UNION ALL SELECT 'decada', {_DECADE} FROM catalogo) WHERE valor IS NOT NULL AND valor <> '' GROUP BY ALL""",
}
