"""A run over fetched pages: references joined with responses, decoded, checked and graded into run items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.operators import integrity, state, triage
from tidemark.operators.lexicon import Lexicon

METADATA_CHANNELS = ("openalex", "crossref", "ia")


def captured(refs: DataFrame, responses: DataFrame) -> DataFrame:
    """References with the text and highlights of their document and why there is none.

    responses: (url, status, corpo binary, cabecalhos). Metadata channels need no response; for the rest, status -1
    means forbidden by robots.txt, any other outside 200..299 and a missing response a failure.
    """
    channel = X.channel(F.col("fonte"))
    meta = channel.isin(*METADATA_CHANNELS)
    r = responses.select(F.col("url").alias("_url"), "status", "corpo", "cabecalhos")
    j = refs.join(r, refs.url == F.col("_url"), "left").drop("_url")
    ok = F.col("status").between(200, 299)
    page = j.withColumn("_p", F.when(ok & ~meta, X.page(X.decode("corpo", F.col("cabecalhos")["content-type"])["text"])))
    head = F.coalesce(F.when(channel != "wayback", F.col("titulo")), X.headline(F.col("_p")), F.lit(""))
    line = X.description(F.col("_p"))
    kind, venue = F.col("dados")["tipo"], F.col("dados")["veiculo"]
    tagged = lambda name, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(name), c))
    summary = F.coalesce(F.col("dados")["resumo"], F.col("dados")["descricao"])
    from_meta = X.metadata_text(F.col("dados")["titulo"], summary, tagged("Tipo: ", kind), tagged("Veículo: ", venue))
    text = F.when(meta, from_meta).otherwise(X.with_parts(F.col("_p.text"), head, line))
    marks = F.when(meta, F.array(F.struct(F.lit("titulo").alias("nome"), F.col("dados")["titulo"].alias("texto")))).otherwise(
        F.array(F.struct(F.lit("manchete").alias("nome"), head.alias("texto")), F.struct(F.lit("linha_fina").alias("nome"), line.alias("texto")))
    )
    tidy = F.transform(marks, lambda h: F.struct(h["nome"].alias("nome"), F.trim(h["texto"]).alias("texto")))
    return page.select(
        *refs.columns,
        X.tidy(text).alias("texto"),
        F.filter(tidy, lambda h: F.coalesce(h["texto"], F.lit("")) != "").alias("destaques"),
        F.when(meta, F.lit(None)).when(F.col("status") == -1, state.BLOCKED).when(~F.coalesce(ok, F.lit(False)), state.FAILED).alias("_failure"),
        F.when(~meta & (F.col("status") == -1), F.concat(F.lit("robots.txt não autoriza "), F.col("url"))).when(~meta & ~F.coalesce(ok, F.lit(False)), X.redact(F.concat_ws(" ", F.lit("HTTP"), F.coalesce(F.col("status").cast("string"), F.lit("sem resposta")), F.lit("em"), "url"))).alias("erro"),
    )


def run_items(refs: DataFrame, responses: DataFrame, lexicon: Lexicon, run: str, least: int = integrity.LEAST, at: Column | None = None) -> DataFrame:
    """Run items of all references: status, hash, grade, and the document for the corpus.

    Texts that fail the integrity check aren't graded, but keep their text. at: time of capture, by default now, in
    whole seconds; references without a document have none.
    """
    docs = captured(refs, responses)
    channel = X.channel(F.col("fonte"))
    sound = F.when(channel.isin(*METADATA_CHANNELS), integrity.metadata_intact(F.col("dados")["titulo"])).when(channel == "wayback", integrity.archive_intact(F.col("texto"), least)).otherwise(integrity.intact(F.col("texto"), least))
    status = F.coalesce("_failure", F.when(sound, state.DONE).otherwise(state.REJECTED))
    at = F.date_trunc("second", F.current_timestamp() if at is None else at)
    docs = triage.pinned(docs, situacao=status, hash_texto=F.when(F.col("_failure").isNull(), F.sha2("texto", 256)))
    graded = triage.graded(docs, lexicon)
    done = F.col("situacao") == state.DONE
    return graded.select(
        F.lit(run).alias("rodada"), *refs.columns, "situacao", "hash_texto", "erro", *(F.when(done, F.col(c)).alias(c) for c in triage.OUTPUT),
        X.item_title(F.col("titulo"), F.col("url"), F.get(F.col("destaques"), F.lit(0))["texto"]).alias("exibido"), F.col("dados")["snapshot"].alias("snapshot"),
        F.when(F.col("hash_texto").isNotNull(), at).alias("capturado_em"), F.when(F.col("hash_texto").isNotNull(), F.col("texto")).alias("texto"), "destaques", F.lit(lexicon.version).alias("lexico_versao"),
    )
