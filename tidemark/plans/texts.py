"""Queries over texts: folding, hashing, lexicon matching, triage, integrity and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.functions.fold import fold, fold_text
from tidemark.operators import integrity, lexicon, runs, triage
from tidemark.session import spread, table

SAMPLE = lexicon.parse(
    {
        "id": "ilha",
        "versao": "2024-07-15",
        "termos": [
            {"chave": "massacre-da-ilha-cinzenta", "formas": ["massacre da Ilha Cinzenta", "Grey Island massacre"], "exclusoes": ["versão oficial do massacre da Ilha Cinzenta"], "peso": 1.5, "categorias": ["evento"]},
            {"chave": "colonia-penal", "formas": ["Colônia Penal", "penal colony", "colonia penal"], "exclusoes": ["direção da colônia penal"], "peso": 1, "categorias": ["lugar"]},
            {"chave": "63-presos", "formas": ["63 presos mortos", "63 dead prisoners"], "peso": 1, "categorias": ["vitimas", "evento"]},
            {"chave": "indulto", "formas": ["pedido de indulto", "proposta de anistia"], "peso": 0.5, "categorias": ["desdobramento-juridico"]},
        ],
        "contexto": {"exige_qualquer": ["processo", "réus", "tribunal", "juíza", "court", "judge"]},
    }
)


def documents(spark: SparkSession, sf: str, *cols: str) -> DataFrame:
    """Stored documents, spread over the cores: matching is CPU-bound and small files have few splits."""
    return spread(table(spark, sf, "documento"), *cols)


def folded_text(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf, "ord", "texto").select("ord", fold(F.col("texto")).alias("dobrado"))


def dedupe_by_hash(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documento").select("ord", F.sha2("texto", 256).alias("hash"))
    return rows.groupBy("hash").agg(F.min("ord").alias("ord"), F.count("*").alias("n"))


def tidied_text(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents"), "doc_id", "text").select("doc_id", X.tidy(F.col("text")).alias("arrumado"))


def term_presence(spark: SparkSession, sf: str) -> DataFrame:
    f = documents(spark, sf, "ord", "texto").select("ord", fold(F.col("texto")).alias("f"))
    marks = [lexicon.has_term(F.col("f"), t.forms).alias(t.key.replace("-", "_")) for t in SAMPLE.terms]
    return f.select("ord", *marks, lexicon.in_context(F.col("f"), SAMPLE).alias("contexto"))


def term_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Occurrences of each term, those inside exclusions included."""
    f = documents(spark, sf, "ord", "texto").select(fold(F.col("texto")).alias("f"))
    each = F.array(*(F.struct(F.lit(t.key).alias("chave"), F.size(lexicon.spans(F.col("f"), lexicon.pattern(t.forms))).cast("bigint").alias("n")) for t in SAMPLE.terms))
    return f.select(F.explode(each).alias("x")).groupBy("x.chave").agg(F.sum("x.n").alias("ocorrencias"), F.count_if(F.col("x.n") > 0).alias("documentos"))


def span_positions(spark: SparkSession, sf: str) -> DataFrame:
    f = documents(spark, sf, "ord", "texto").select("ord", "texto", fold(F.col("texto")).alias("f"))
    o = f.select("ord", "texto", F.explode(lexicon.occurrences(F.col("f"), SAMPLE)["valid"]).alias("o"))
    return o.select("ord", F.col("o.term").alias("termo"), F.col("o.start").alias("inicio"), F.col("o.end").alias("fim"), F.expr("substring(texto, o.start + 1, o.end - o.start)").alias("forma"))


def _graded(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return triage.graded(documents(spark, sf, "ord", "fonte", "texto", "destaques"), SAMPLE, columns=columns)


def triage_levels(spark: SparkSession, sf: str) -> DataFrame:
    g = _graded(spark, sf, "nivel", "motivo", "pontuacao", "chaves", "categorias", "onde")
    return g.select("ord", "nivel", "motivo", "pontuacao", F.array_join(F.array_sort("chaves"), ";").alias("chaves"), F.array_join(F.array_sort("categorias"), ";").alias("categorias"), "onde")


def triage_snippets(spark: SparkSession, sf: str) -> DataFrame:
    """Passages shown for judgement; keys in the order of their first occurrence."""
    g = _graded(spark, sf, "nivel", "chaves", "trecho", "onde").filter("trecho is not null")
    return g.select("ord", "nivel", F.array_join("chaves", ";").alias("chaves"), "trecho", "onde")


def triage_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _graded(spark, sf, "nivel", "motivo").groupBy("nivel", "motivo").agg(F.count("*").alias("n"))


def facet_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _graded(spark, sf, "nivel", "categorias").select("nivel", F.explode("categorias").alias("categoria")).groupBy("categoria", "nivel").agg(F.count("*").alias("n"))


def integrity_check(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("texto")
    return table(spark, sf, "documento").select("ord", integrity.intact(t).alias("integro"), integrity.archive_intact(t).alias("integro_arquivo"), integrity.metadata_intact(F.col("titulo")).alias("tem_titulo"))


def decoded_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Encoding used for each stored page, and the length of its text."""
    d = documents(spark, sf, "ord", "bruto", "cabecalhos").filter("bruto is not null")
    got = d.select("ord", X.decode("bruto", F.col("cabecalhos")["content-type"]).alias("d"))
    return got.select("ord", F.col("d.encoding").alias("codificacao"), F.length("d.text").cast("bigint").alias("caracteres"))


def page_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Visible text and headline of each stored page."""
    d = documents(spark, sf, "ord", "bruto", "cabecalhos").filter("bruto is not null")
    p = d.select("ord", X.page(X.decode("bruto", F.col("cabecalhos")["content-type"])["text"]).alias("p"))
    head = X.headline(F.col("p"))
    return p.select("ord", head.alias("manchete"), X.description(F.col("p")).alias("linha_fina"), X.with_parts(F.col("p.text"), head, X.description(F.col("p"))).alias("texto"))


def page_headings(spark: SparkSession, sf: str) -> DataFrame:
    """First-level headings of all stored pages, whatever their encoding and character references."""
    d = documents(spark, sf, "ord", "bruto", "cabecalhos").filter("bruto is not null")
    p = d.select("ord", X.page(X.decode("bruto", F.col("cabecalhos")["content-type"])["text"]).alias("p"))
    return p.select("ord", F.explode(F.array("p.h1")).alias("h1")).filter("h1 is not null")


def documents_json(spark: SparkSession, sf: str) -> DataFrame:
    """Stored documents written as JSON and read back."""
    d = runs.document_from_json(runs.document_json(documents(spark, sf)))
    marks = F.array_join(F.transform(F.array_sort("destaques"), lambda h: F.concat(h["nome"], F.lit("="), h["texto"])), ";")
    heads = F.array_join(F.transform(F.array_sort(F.map_entries("cabecalhos")), lambda h: F.concat(h["key"], F.lit("="), h["value"])), ";")
    return d.select("ord", "fonte", "id_na_fonte", "url", "titulo", "publicado_em", F.date_format("capturado_em", "yyyy-MM-dd HH:mm:ss").alias("capturado_em"), "hash_texto", "texto", heads.alias("cabecalhos"), F.coalesce(marks, F.lit("")).alias("destaques"))


QUERIES = {f.__name__: f for f in (triage_counts, triage_levels, triage_snippets, facet_counts, folded_text, dedupe_by_hash, tidied_text, term_presence, term_counts, span_positions, integrity_check, decoded_pages, page_texts, page_headings, documents_json)}


def _forms(forms: tuple[str, ...]) -> str:
    words = [fold_text(f).strip() for f in sorted(set(forms), key=lambda f: (-len(f), f))]
    return "\\b(?:" + "|".join(r"\s+".join(w.split()) for w in words) + ")\\b"


def _n(col: str, forms: tuple[str, ...]) -> str:
    return f"len(regexp_extract_all({col}, '{_forms(forms)}'))" if forms else "0"


_T = SAMPLE.terms
_FOLD = "lower(strip_accents({}))"
_VALID = [f"({_n('f', t.forms)} - {_n('f', t.exclusions)} > 0)" for t in _T]
_HIT = " OR ".join(f"({_n('h.f', t.forms)} - {_n('h.f', t.exclusions)} > 0)" for t in _T)
_GRADED = f"""
WITH d AS (SELECT ord, coalesce({_FOLD.format('texto')}, '') AS f, coalesce(destaques, []) AS hs FROM documento),
v AS (SELECT ord, {', '.join(f'{c} AS t{i}' for i, c in enumerate(_VALID))}, {' + '.join(_n('f', t.exclusions) for t in _T)} > 0 AS void,
  regexp_matches(f, '{_forms(SAMPLE.context)}') AS ctx,
  list_filter(list_transform(hs, lambda x: {{'nome': x.nome, 'f': {_FOLD.format('x.texto')}}}), lambda h: {_HIT}) AS hits FROM d),
g AS (SELECT *, ({' OR '.join(f't{i}' for i in range(len(_T)))}) AS has FROM v),
graded AS (SELECT ord,
  CASE WHEN NOT has THEN 0 WHEN NOT ctx THEN 1 WHEN len(hits) > 0 THEN 3 ELSE 2 END AS nivel,
  CASE WHEN NOT has AND void THEN 'so_exclusao' WHEN NOT has THEN 'sem_termo' WHEN NOT ctx THEN 'sem_contexto' WHEN len(hits) > 0 THEN 'aceito' ELSE 'pede_juizo' END AS motivo,
  {' + '.join(f'CASE WHEN t{i} THEN {t.weight}::DOUBLE ELSE 0 END' for i, t in enumerate(_T))} AS pontuacao,
  list_sort(list_filter([{', '.join(f"CASE WHEN t{i} THEN '{t.key}' END" for i, t in enumerate(_T))}], lambda x: x IS NOT NULL)) AS chaves,
  list_sort(list_distinct(flatten([{', '.join(f"CASE WHEN t{i} THEN {list(t.categories)} ELSE [] END" for i, t in enumerate(_T))}]))) AS categorias,
  CASE WHEN has AND ctx AND len(hits) > 0 THEN hits[1].nome WHEN has OR void THEN 'texto' END AS onde FROM g)
"""
def _spans(f: str, forms: tuple[str, ...], term: int) -> str:
    """Matches in folded text as a list of {s, t, e}; offsets are the lengths of what stands before."""
    if not forms:
        return "[]::STRUCT(s BIGINT, t BIGINT, e BIGINT)[]"
    g, m = f"string_split_regex({f}, '{_forms(forms)}')", f"regexp_extract_all({f}, '{_forms(forms)}')"
    size = lambda x: f"coalesce(list_sum(list_transform({x}, lambda z: length(z))), 0)"
    start = f"({size(f'({g})[1:i]')} + {size(f'({m})[1:i - 1]')})::BIGINT"
    return f"list_transform(range(1, len({m}) + 1), lambda i: {{'s': {start}, 't': {term}::BIGINT, 'e': ({start} + length(({m})[i]))::BIGINT}})"


def _kept(f: str, inside: bool) -> str:
    """Occurrences of all terms in (or out of) exclusions, by term."""
    each = [f"list_filter({_spans(f, t.forms, n)}, lambda o: {'' if inside else 'NOT '}len(list_filter({_spans(f, t.exclusions, n)}, lambda x: x.s <= o.s AND o.e <= x.e)) > 0)" for n, t in enumerate(_T)]
    return f"flatten([{', '.join(each)}])"


def _snippet(text: str, at: str) -> str:
    a, b = f"greatest({at}.s - 160, 0)", f"least({at}.e + 160, length({text}))"
    return f"CASE WHEN {a} > 0 THEN '…' ELSE '' END || trim(regexp_replace(substring({text}, {a} + 1, {b} - {a}), '[\\s\\x{{1c}}-\\x{{1f}}\\x{{85}}\\p{{Z}}]+', ' ', 'g')) || CASE WHEN {b} < length({text}) THEN '…' ELSE '' END"


_KEYS = "[" + ", ".join(f"'{t.key}'" for t in _T) + "]"
_SPANNED = f"""
WITH d AS (SELECT ord, coalesce(texto, '') AS texto, {_FOLD.format("coalesce(texto, '')")} AS f, coalesce(destaques, []) AS hs FROM documento),
sp AS MATERIALIZED (SELECT *, list_sort({_kept('f', False)}) AS valid, {_kept('f', True)} AS void, regexp_matches(f, '{_forms(SAMPLE.context)}') AS ctx FROM d)"""
_SNIPPETS = f"""{_SPANNED},
u AS (SELECT ord, unnest(hs) AS h, generate_subscripts(hs, 1) AS n FROM sp WHERE ctx AND len(valid) > 0),
v AS MATERIALIZED (SELECT ord, n, h.nome AS nome, h.texto AS t, list_sort({_kept(_FOLD.format('h.texto'), False)}) AS hv FROM u),
hit AS (SELECT ord, arg_min(nome, n) AS nome, arg_min(t, n) AS t, arg_min(hv, n) AS hv FROM v WHERE len(hv) > 0 GROUP BY 1),
g AS (SELECT sp.*, hit.nome, hit.t, hit.hv[1] AS ha, coalesce(valid[1], void[1]) AS pos FROM sp LEFT JOIN hit USING (ord)),
o AS (SELECT ord, string_agg(({_KEYS})[t + 1], ';' ORDER BY s, t) AS chaves FROM (SELECT ord, x.t AS t, min(x.s) AS s FROM (SELECT ord, unnest(valid) AS x FROM sp) GROUP BY ALL) GROUP BY 1)
SELECT ord, CASE WHEN len(valid) = 0 THEN 0 WHEN NOT ctx THEN 1 WHEN ha IS NOT NULL THEN 3 ELSE 2 END AS nivel, coalesce(chaves, '') AS chaves,
  CASE WHEN ha IS NOT NULL THEN {_snippet('t', 'ha')} ELSE {_snippet('texto', 'pos')} END AS trecho, CASE WHEN ha IS NOT NULL THEN nome ELSE 'texto' END AS onde
FROM g LEFT JOIN o USING (ord) WHERE pos IS NOT NULL"""
_HIGH = bytes(range(0x80, 0xA0)).decode("cp1252", "replace")


def _latin(digits: str) -> str:
    """Bytes given as hexadecimal digits, read as cp1252."""
    return f"array_to_string(list_transform(range(1, len({digits}) // 2 + 1), lambda i: CASE WHEN ({digits})[2 * i - 1] IN ('8', '9') THEN '{_HIGH}'[('0x' || ({digits})[2 * i - 1:2 * i])::INT - 127] ELSE chr(('0x' || ({digits})[2 * i - 1:2 * i])::INT) END), '')"


_DECLARED = "lower(regexp_extract({}, '(?i){}charset\\s*=\\s*[\"'']?\\s*([\\w\\-]+)', 1))"
_DECODED = f"""
WITH p AS (SELECT ord, bruto, {_DECLARED.format("coalesce(map_extract(cabecalhos, 'content-type')[1], '')", '')} AS h, try(decode(bruto)) AS u FROM documento WHERE bruto IS NOT NULL),
m AS (SELECT *, CASE WHEN h = '' THEN {_DECLARED.format(f"coalesce(substring(u, 1, 4096), {_latin('hex(bruto)[1:8192]')})", '<meta[^>]+')} ELSE '' END AS m FROM p),
q AS (SELECT ord, bruto, u, CASE WHEN hex(bruto)[1:6] = 'EFBBBF' THEN 'utf-8-sig' WHEN hex(bruto)[1:4] IN ('FFFE', 'FEFF') THEN 'utf-16' ELSE coalesce(list_filter(
  list_transform([h, m, 'utf-8', 'cp1252'], lambda x: CASE WHEN x IN ('iso-8859-1', 'latin-1', 'latin1', 'us-ascii') THEN 'cp1252' ELSE x END),
  lambda x: (x = 'utf-8' AND u IS NOT NULL) OR (x = 'cp1252' AND NOT regexp_matches(hex(bruto), '^(?:..)*(?:81|8D|8F|90|9D)')))[1], 'cp1252') END AS codificacao FROM m)
"""
_STRIP = "[ \\t\\f\\x{0b}\\x{1c}-\\x{1f}\\x{85}\\p{Z}]"
_TIDY = f"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  replace(replace(nfc_normalize(text), chr(160), ' '), chr(13), ''), '[ \\t\\f\\x{{0b}}]+', ' ', 'g'), '{_STRIP}*\\n', chr(10), 'g'), '\\n{_STRIP}+', chr(10), 'g'),
  '\\n{{3,}}', chr(10) || chr(10), 'g'), '^[\\n\\t\\f\\x{{0b}} \\x{{1c}}-\\x{{1f}}\\x{{85}}\\p{{Z}}]+', ''), '[\\n\\t\\f\\x{{0b}} \\x{{1c}}-\\x{{1f}}\\x{{85}}\\p{{Z}}]+$', '') AS arrumado FROM documents"""
_MARKS = lambda marks: " OR ".join("contains(lower(substring(texto, 1, 300)), '" + m.replace("'", "''") + "')" for m in marks)
_INTACT = "coalesce(length(texto) >= 400 AND (length(texto) >= 2500 OR NOT ({})), false)"

SQL = {
    "tidied_text": _TIDY,
    "span_positions": _SPANNED + "SELECT ord, (o.t)::INT AS termo, (o.s)::INT AS inicio, (o.e)::INT AS fim, substring(texto, o.s + 1, o.e - o.s) AS forma FROM (SELECT ord, texto, unnest(valid) AS o FROM sp)",
    "triage_snippets": _SNIPPETS,
    "documents_json": """SELECT ord, fonte, id_na_fonte, url, titulo, publicado_em, strftime(capturado_em AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS capturado_em, hash_texto, texto,
  array_to_string(list_transform(list_sort(map_entries(cabecalhos)), lambda h: h.key || '=' || h.value), ';') AS cabecalhos,
  coalesce(array_to_string(list_transform(list_sort(destaques), lambda h: h.nome || '=' || h.texto), ';'), '') AS destaques FROM documento""",
    "triage_counts": _GRADED + "SELECT nivel, motivo, count(*) AS n FROM graded GROUP BY ALL",
    "triage_levels": _GRADED + "SELECT ord, nivel, motivo, pontuacao, array_to_string(chaves, ';') AS chaves, array_to_string(categorias, ';') AS categorias, onde FROM graded",
    "facet_counts": _GRADED + "SELECT categoria, nivel, count(*) AS n FROM (SELECT nivel, unnest(categorias) AS categoria FROM graded) GROUP BY ALL",
    "folded_text": f"SELECT ord, {_FOLD.format('texto')} AS dobrado FROM documento",
    "dedupe_by_hash": "SELECT sha256(texto) AS hash, min(ord) AS ord, count(*) AS n FROM documento GROUP BY 1",
    "term_presence": "SELECT ord, "
    + ", ".join(f"regexp_matches({_FOLD.format('texto')}, '{_forms(t.forms)}') AS {t.key.replace('-', '_') if not t.key[0].isdigit() else chr(34) + t.key.replace('-', '_') + chr(34)}" for t in _T)
    + f", regexp_matches({_FOLD.format('texto')}, '{_forms(SAMPLE.context)}') AS contexto FROM documento",
    "term_counts": " UNION ALL ".join(f"SELECT '{t.key}' AS chave, sum(n)::BIGINT AS ocorrencias, count(*) FILTER (n > 0) AS documentos FROM (SELECT {_n(_FOLD.format('texto'), t.forms)} AS n FROM documento)" for t in _T),
    "integrity_check": f"SELECT ord, {_INTACT.format(_MARKS(integrity.ERROR_MARKS))} AS integro, {_INTACT.format(_MARKS(integrity.ERROR_MARKS + integrity.ARCHIVE_MARKS))} AS integro_arquivo, coalesce(titulo <> '', false) AS tem_titulo FROM documento",
    "decoded_pages": _DECODED + "SELECT ord, codificacao, CASE codificacao WHEN 'utf-8' THEN length(u) WHEN 'utf-8-sig' THEN length(u) - 1 WHEN 'utf-16' THEN octet_length(bruto) // 2 - 1 ELSE octet_length(bruto) END::BIGINT AS caracteres FROM q",
    # a heading without markup of its own, from the bytes between its tags
    "page_headings": _DECODED
    + f"""SELECT ord, trim(regexp_replace(CASE WHEN codificacao LIKE 'utf-8%' THEN decode(unhex(h)) ELSE {_latin('h')} END, '[ \\t]+', ' ', 'g')) AS h1
FROM (SELECT *, regexp_extract(hex(bruto), '^(?:..)*?3C68313E((?:..)*?)3C2F68313E', 1) AS h FROM q) WHERE h <> ''""",
}
