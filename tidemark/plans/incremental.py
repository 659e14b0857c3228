"""Queries of the incremental operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import incremental
from tidemark.session import table


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    got = incremental.ingest(spark, f"{sf}/openalex_listagem.parquet", table(spark, sf, "openalex_carandiru"))
    return got.select("rodada", "id_na_fonte")


def p5_state(spark: SparkSession, sf: str) -> DataFrame:
    """State after all due runs: the version that now counts as processed for each id."""
    saves = table(spark, sf, "openalex_carandiru")
    fresh = incremental.ingest(spark, f"{sf}/openalex_listagem.parquet", saves).groupBy("id_na_fonte").agg(F.max_by("hash_texto", "rodada").alias("hash_texto"), F.lit(True).alias("is_due"))
    saved = incremental.saved_state(saves)
    j = saved.join(fresh, "id_na_fonte", "full")
    return j.select("id_na_fonte", F.when(F.col("is_due"), F.col("hash_texto")).otherwise(F.col("saved_hash")).alias("hash_texto"))


QUERIES = {"p5_found": p5_found, "p5_state": p5_state}

_CASES = """
WITH saved AS (
  SELECT id_na_fonte, arg_max(h, gravacao) AS saved_hash FROM (
    SELECT gravacao, unnest(map_keys(vistos)) AS id_na_fonte, unnest(map_values(vistos)) AS h FROM openalex_carandiru) GROUP BY 1),
cur AS (
  SELECT rodada, id_na_fonte, hash_texto FROM openalex_listagem
  WHERE id_na_fonte IS NOT NULL AND rodada IS NOT NULL AND rodada NOT IN (SELECT rodada FROM openalex_carandiru WHERE rodada IS NOT NULL)
  QUALIFY row_number() OVER (PARTITION BY rodada, id_na_fonte ORDER BY atualizado_em DESC NULLS LAST, ord DESC) = 1),
seq AS (
  SELECT *, row_number() OVER w AS n, lag(hash_texto) OVER w AS prev FROM cur WINDOW w AS (PARTITION BY id_na_fonte ORDER BY rodada)),
cases AS (
  SELECT q.rodada, q.id_na_fonte, q.hash_texto FROM seq q LEFT JOIN (SELECT *, true AS known FROM saved) s USING (id_na_fonte)
  WHERE CASE WHEN q.n = 1 THEN s.known IS NULL OR q.hash_texto IS DISTINCT FROM s.saved_hash ELSE q.hash_texto IS DISTINCT FROM q.prev END)
"""

SQL = {
    "p5_found": _CASES + "SELECT rodada, id_na_fonte FROM cases",
    "p5_state": _CASES
    + """, fresh AS (SELECT id_na_fonte, arg_max(hash_texto, rodada) AS hash_texto, true AS is_due FROM cases GROUP BY 1)
SELECT id_na_fonte, CASE WHEN f.is_due THEN f.hash_texto ELSE s.saved_hash END AS hash_texto FROM saved s FULL JOIN fresh f USING (id_na_fonte)""",
}
