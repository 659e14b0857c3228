"""Grading of documents by a lexicon: one projection, no shuffle.

Level 0 has no valid occurrence, 1 lacks context, 2 needs judgement, 3 is accepted, as a highlight itself holds a valid
occurrence (the first such highlight in order counts). Keys, categories and score come from the text alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.functions.fold import fold
from tidemark.operators.lexicon import Lexicon, in_context, let, occurrences


OUTPUT = ("nivel", "motivo", "chaves", "categorias", "pontuacao", "trecho", "onde")


def pinned(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are computed once per row.

    They pass through a generator of one row, so the optimizer can't inline their expressions into every later use or
    into filters it moves below, which would run the matching again each time.
    """
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(k) for k, c in columns.items())))))


def _literals(values) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def graded(docs: DataFrame, lexicon: Lexicon, text: str = "texto", highlights: str | None = "destaques", names: tuple[str, str] = ("nome", "texto"), columns: tuple[str, ...] = OUTPUT) -> DataFrame:
    """docs with those of `columns`: nivel, motivo, chaves, categorias, pontuacao, trecho and onde; null texts grade as empty ones.

    Columns of docs of the same names are replaced. Repeated rows are graded each.
    """
    name, inner = names
    kept = [c for c in docs.columns if c not in OUTPUT]
    base = docs.select(*(F.col(f"`{c}`") for c in kept), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    base = pinned(base, _folded=fold(F.col("_text")))
    found = occurrences(F.col("_folded"), lexicon)
    base = pinned(base, _o=found, _context=in_context(F.col("_folded"), lexicon)).drop("_folded")
    valid, void = F.col("_o.valid"), F.col("_o.void")
    some = F.size(valid) > 0
    if highlights:
        seen = F.filter(
            F.transform(F.coalesce(F.col(highlights), F.array()), lambda h: F.struct(h[name].alias("name"), h[inner].alias("text"), let(fold(h[inner]), lambda f: occurrences(f, lexicon)["valid"]).alias("valid"))),
            lambda h: F.size(h["valid"]) > 0,
        )
        # highlights are searched only where the text passed
        hit = F.when(some & F.col("_context"), F.get(seen, F.lit(0)))
    else:
        hit = F.lit(None).cast("struct<name:string,text:string,valid:array<struct<start:int,term:int,end:int>>>")
    # distinct terms by first position
    base = pinned(base, _terms=F.array_distinct(F.transform(valid, lambda o: o["term"])), _hit=hit)
    look = lambda values: F.transform(F.col("_terms"), lambda n: F.get(F.array(*values), n))
    hit = F.col("_hit").isNotNull()
    first = lambda xs: F.get(xs, F.lit(0))
    at = F.when(some, first(valid)).otherwise(first(void))
    inside = F.col("_hit.valid")
    made = dict(
        nivel=F.when(~some, 0).when(~F.col("_context"), 1).when(hit, 3).otherwise(2),
        motivo=F.when(~some & (F.size(void) > 0), "so_exclusao").when(~some, "sem_termo").when(~F.col("_context"), "sem_contexto").when(hit, "aceito").otherwise("pede_juizo"),
        chaves=look([F.lit(t.key) for t in lexicon.terms]),
        categorias=F.array_distinct(F.flatten(look([_literals(t.categories) for t in lexicon.terms]))),
        pontuacao=F.bround(F.aggregate(look([F.lit(t.weight) for t in lexicon.terms]), F.lit(0.0), lambda a, w: a + w), 4),
        trecho=F.when(hit, X.snippet(F.col("_hit.text"), first(inside)["start"], first(inside)["end"])).when(at.isNotNull(), X.snippet(F.col("_text"), at["start"], at["end"])),
        onde=F.when(hit, F.col("_hit.name")).when(at.isNotNull(), "texto"),
    )
    # a pinned column is computed whether it is used or not, so only the wanted ones are
    out = pinned(base, **{c: made[c] for c in columns})
    return out.select(*(F.col(f"`{c}`") for c in kept), *columns)
