"""Runs: counts, flags, exit codes, record sinks and grouped reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.operators import state


def counts(items: DataFrame) -> DataFrame:
    """(rodada, grupo, valor, n): items by status and triaged items by reason."""
    by = F.array(F.struct(F.lit("situacao").alias("grupo"), F.col("situacao").alias("valor")), F.struct(F.lit("motivo").alias("grupo"), F.col("motivo").alias("valor")))
    return items.select("rodada", F.explode(by).alias("x")).filter("x.valor is not null").groupBy("rodada", "x.grupo", "x.valor").agg(F.count("*").alias("n"))


def summary(items: DataFrame, failures: DataFrame) -> DataFrame:
    """(rodada, itens, pede_leitura, codigo): 2 where a source failed, else 3 where something asks to be read, else 0."""
    bad = failures.select("rodada").distinct().withColumn("_failed", F.lit(True))
    per = items.groupBy("rodada").agg(F.count("*").alias("itens"), F.coalesce(F.bool_or(F.col("nivel") >= 2), F.lit(False)).alias("pede_leitura"))
    code = F.when(F.coalesce("_failed", F.lit(False)), 2).when(F.col("pede_leitura"), 3).otherwise(0)
    return per.join(bad, "rodada", "left").select("rodada", "itens", "pede_leitura", code.alias("codigo"))


def records(items: DataFrame, lexicon_id: str, version: str) -> dict[str, DataFrame]:
    """The three record sinks: every item, accepted ones and those that need judgement, stamped with the lexicon."""
    stamped = items.withColumns({"lexico_id": F.lit(lexicon_id), "lexico_versao": F.lit(version)})
    done = stamped.filter(F.col("situacao") == state.DONE) if "situacao" in items.columns else stamped
    return {"itens": stamped, "aceitos": done.filter("nivel = 3"), "pede-juizo": done.filter("nivel = 2")}


def write_records(sinks: dict[str, DataFrame], root: str) -> None:
    """JSON lines of each sink, written by batch of the run's folder so a rerun replaces them."""
    for name, df in sinks.items():
        df.write.mode("overwrite").json(f"{root}/{name}.jsonl")


#: Sections of a run's report, in the full report's order; the summary has the first three.
SECTIONS = ("juizo", "aceitos", "falhas", "robots", "nivel1", "nivel0")


def section() -> Column:
    """The report's section of an item; null for a status or level that belongs to none."""
    level = F.when(F.col("situacao") == state.DONE, F.col("nivel"))
    return (
        F.when(level == 3, "aceitos")
        .when(level == 2, "juizo")
        .when(level == 1, "nivel1")
        .when(level == 0, "nivel0")
        .when(F.col("situacao").isin(state.FAILED, state.REJECTED), "falhas")
        .when(F.col("situacao") == state.BLOCKED, "robots")
    )


def buckets(items: DataFrame) -> DataFrame:
    """(rodada, secao, n): items by section of the report."""
    return items.groupBy("rodada", section().alias("secao")).agg(F.count("*").alias("n")).filter("secao is not null")


def report_rows(items: DataFrame) -> DataFrame:
    """(rodada, secao, ord, linha): one line of the run's report for each item, titles cut to 120 and errors to 200
    characters. A row stays a row: reports of any length are written by the cluster."""
    name = F.coalesce(F.nullif(F.substring(X.cell(F.col("titulo")), 1, 120), F.lit("")), F.col("id_na_fonte"))
    grade = F.concat(F.lit(" — nível "), F.col("nivel").cast("string"), F.lit(", "), F.col("motivo"), F.when(F.size("chaves") > 0, F.concat(F.lit(": "), F.array_join("chaves", ", "))).otherwise(""))
    detail = F.when(F.col("situacao") == state.DONE, F.coalesce(grade, F.lit(""))).when(X.cell(F.col("erro")) != "", F.concat(F.lit(" — "), F.substring(X.cell(F.col("erro")), 1, 200))).otherwise("")
    copy = F.when(F.coalesce("snapshot", F.lit("")) != "", F.concat(F.lit(" — [arquivado]("), F.col("snapshot"), F.lit(")"))).otherwise("")
    line = F.concat(F.lit("* ["), name, F.lit("]("), F.coalesce("url", F.lit("")), F.lit("), "), F.col("fonte"), detail, copy)
    return items.select("rodada", section().alias("secao"), "ord", line.alias("linha")).filter("secao is not null")


def corpus(documents: DataFrame, intact: str) -> DataFrame:
    """(fonte, hash_texto, caminho, ord): stored texts, one per source and hash, the latest reference winning; rejected ones
    stay out."""
    good = documents.filter(F.col(intact)).groupBy("fonte", "hash_texto").agg(F.max("ord").alias("ord"))
    return good.select("fonte", "hash_texto", F.concat_ws("/", X.safe_name(F.col("fonte")), F.concat("hash_texto", F.lit(".json"))).alias("caminho"), "ord")


#: What of a run item the corpus keeps.
CORPUS = ("fonte", "id_na_fonte", "url", "titulo", "publicado_em", "capturado_em", "hash_texto", "texto", "destaques", "ord")


def write_corpus(items: DataFrame, root: str, run: str) -> None:
    """Sound documents below root/corpus, rejected ones apart below root/quarentena, as the run's own part: a run that is
    repeated replaces it, and none but sound documents are ever read as corpus."""
    kept = items.filter("texto is not null").select("situacao", *CORPUS)
    for folder, status in (("corpus", state.DONE), ("quarentena", state.REJECTED)):
        kept.filter(F.col("situacao") == status).drop("situacao").write.mode("overwrite").parquet(f"{root}/{folder}/run={run}")


def read_corpus(spark: SparkSession, root: str) -> DataFrame:
    """Stored documents, one for each source and text, with the reference of the latest run that had it."""
    d = spark.read.option("basePath", f"{root}/corpus").parquet(f"{root}/corpus")
    latest = F.max_by(F.struct(*(c for c in CORPUS if c not in ("fonte", "hash_texto"))), F.struct("run", "ord"))
    return d.groupBy("fonte", "hash_texto").agg(latest.alias("d")).select("fonte", "hash_texto", "d.*").select(*CORPUS)


def document_json(documents: DataFrame) -> DataFrame:
    """(documents' keys, json): a document as JSON for interchange; extra data and the page as served stay out."""
    ref = F.struct("fonte", "id_na_fonte", "url", "titulo", F.col("publicado_em").cast("string").alias("publicado_em"))
    marks = F.map_from_entries(F.filter(F.coalesce("destaques", F.array()), lambda h: h["nome"].isNotNull()))
    body = F.struct(ref.alias("ref"), "texto", F.date_format("capturado_em", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("capturado_em"), "hash_texto", "cabecalhos", marks.alias("destaques"))
    return documents.select("ord", F.to_json(body).alias("json"))


DOCUMENT = (
    "ref struct<fonte:string,id_na_fonte:string,url:string,titulo:string,publicado_em:string>, texto string, capturado_em string, hash_texto string, "
    "cabecalhos map<string,string>, destaques map<string,string>"
)


def document_from_json(rows: DataFrame) -> DataFrame:
    """Documents from their JSON; absent headers and highlights are null."""
    d = rows.select("ord", F.from_json("json", DOCUMENT).alias("d")).select("ord", "d.*")
    marks = F.transform(F.map_entries("destaques"), lambda e: F.struct(e["key"].alias("nome"), e["value"].alias("texto")))
    return d.select("ord", "ref.fonte", "ref.id_na_fonte", "ref.url", "ref.titulo", F.col("ref.publicado_em").cast("date").alias("publicado_em"), F.to_timestamp("capturado_em").alias("capturado_em"), "hash_texto", "texto", "cabecalhos", marks.alias("destaques"))
