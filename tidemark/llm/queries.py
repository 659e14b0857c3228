"""Queries of the training-data operators, by problem number."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import abuse, boilerplate, encode, garbled, history, language, mixing, neardup, residue
from tidemark.llm.sql import SQL  # noqa: F401
from tidemark.session import table


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return residue.found(table(spark, sf, "documento"), table(spark, sf, "itens")).select("ord", "campo")


def p1_kinds(spark: SparkSession, sf: str) -> DataFrame:
    """Residue by field and kind, for review."""
    return residue.found(table(spark, sf, "documento"), table(spark, sf, "itens"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return garbled.found(table(spark, sf, "itens"), table(spark, sf, "pede_juizo")).select("campo", "ord")


def p2_restored(spark: SparkSession, sf: str) -> DataFrame:
    """Garbled values with the text restored where it can be."""
    return garbled.found(table(spark, sf, "itens"), table(spark, sf, "pede_juizo"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return history.known(*(table(spark, sf, t) for t in ("lotes", "catalogo", "documento", "openalex_carandiru")))


def p3_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates known by page identity, text hash or source id alone."""
    return history.exact(*(table(spark, sf, t) for t in ("lotes", "catalogo", "openalex_carandiru")))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    pairs = neardup.similar_pairs(table(spark, sf, "documento"))
    return pairs.select(F.col("a").alias("ord_a"), F.col("b").alias("ord_b"))


def p4_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Each stored document with the group of nearly equal documents it belongs to."""
    return neardup.groups(table(spark, sf, "documento"))


def p4_copies(spark: SparkSession, sf: str) -> DataFrame:
    """Each stored document with the first one of the same text, however short, and their number."""
    return neardup.copies(table(spark, sf, "documento"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return language.found(table(spark, sf, "itens"), table(spark, sf, "pede_juizo"))


def p6_stretches(spark: SparkSession, sf: str) -> DataFrame:
    """Language and confidence of each stretch of each text."""
    return language.stretches(table(spark, sf, "itens"), table(spark, sf, "pede_juizo"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return boilerplate.furniture(table(spark, sf, "documento")).select("ord", "linha")


def p7_body(spark: SparkSession, sf: str) -> DataFrame:
    """Each stored text without the page around it."""
    return boilerplate.main_body(table(spark, sf, "documento"))


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    return encode.encode(table(spark, sf, "documents"))


def p8_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """Where each token stands in its text."""
    return encode.offsets(table(spark, sf, "documents"))


def p8_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    return encode.round_trip(table(spark, sf, "documents"))


def p9_mix(spark: SparkSession, sf: str) -> DataFrame:
    """Each used document with its rate and whole number of copies."""
    return mixing.copies(mixing.token_table(table(spark, sf, "documents")), table(spark, sf, "mistura_alvo"))


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Target and actual share of tokens of each source."""
    tokens, mix = mixing.token_table(table(spark, sf, "documents")), table(spark, sf, "mistura_alvo")
    return mixing.shares(mixing.copies(tokens, mix), tokens, mix)


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    scored = abuse.score(table(spark, sf, "documents"), table(spark, sf, "rotulos"))
    return scored.filter(F.col("score") >= abuse.FOUND).select("doc_id")


def p10_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Score, calibrated rate and evidence of each document."""
    return abuse.score(table(spark, sf, "documents"), table(spark, sf, "rotulos"))


def p10_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Rate of abusive documents of each source."""
    return abuse.rates(abuse.score(table(spark, sf, "documents"), table(spark, sf, "rotulos")))


QUERIES = {f.__name__: f for f in (p1_found, p1_kinds, p2_found, p2_restored, p3_found, p3_exact, p4_found, p4_groups, p4_copies, p6_found, p6_stretches, p7_found, p7_body, p8_ids, p8_offsets, p8_round_trip, p9_mix, p9_shares, p10_found, p10_scores, p10_rates)}
