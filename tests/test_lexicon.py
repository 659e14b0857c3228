import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.functions.fold import fold_text
from tidemark.operators import integrity, triage
from tidemark.operators import lexicon as L

LEX = L.parse(
    {
        "id": "t",
        "versao": "1",
        "termos": [
            {"chave": "ilha", "formas": ["massacre da ilha"], "exclusoes": ["filme massacre da ilha"], "categorias": ["evento"]},
            {"chave": "portaria", "formas": ["portaria 88 … regimento interno", "portaria 88"], "peso": 0.5, "categorias": ["norma", "evento"]},
        ],
        "contexto": {"exige_qualquer": ["presos"]},
    }
)


def brute(forms):
    alternatives = []
    for form in sorted(forms, key=lambda f: (-len(f), f)):
        pieces = [r"\s+".join(re.escape(w) for w in p.split()) for p in fold_text(form).split("…")]
        alternatives.append(r"(?!\w)[^;\n]{0,60}?(?<!\w)".join(pieces))
    return re.compile(r"(?<!\w)(?:" + "|".join(alternatives) + r")(?!\w)")


def test_spans_equal_python(spark):
    rng = random.Random(3)
    words = ["massacre", "da", "ilha", "portaria", "88", "880", "regimento interno", ";", "\n", "é", "x", "filme", "  "]
    texts = [fold_text(" ".join(rng.choices(words, k=30))) for _ in range(300)] + [""]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(4)
    for term in LEX.terms:
        got = df.select("t", L.spans(F.col("t"), L.pattern(term.forms)).alias("s")).collect()
        for r in got:
            assert [(x.start, x.end) for x in r.s] == [m.span() for m in brute(term.forms).finditer(r.t)], r.t


@pytest.mark.parametrize(
    ("text", "level", "reason"),
    [
        ("nada aqui", 0, "sem_termo"),
        (None, 0, "sem_termo"),
        ("o filme massacre da ilha", 0, "so_exclusao"),
        ("O Massacre da  Ilha", 1, "sem_contexto"),
        ("O MASSACRE DA ILHA e os presos", 2, "pede_juizo"),
        ("filme massacre da ilha; massacre da ilha, presos", 2, "pede_juizo"),
        ("massacre da ilhas presos", 0, "sem_termo"),
    ],
)
def test_levels(spark, text, level, reason):
    df = spark.createDataFrame([(1, text, None)], "ord int, texto string, destaques array<struct<nome:string,texto:string>>")
    r = triage.graded(df, LEX).first()
    assert (r.nivel, r.motivo) == (level, reason)


def test_highlight_accepts_and_scores(spark):
    rows = [(1, "Portaria 88, anexo 2, do Regimento Interno e massacre da ilha, presos", [("manchete", "nada"), ("linha_fina", "a portaria 88")], 9)]
    df = spark.createDataFrame(rows, "ord int, texto string, destaques array<struct<nome:string,texto:string>>, nivel int")  # a clashing column
    r = triage.graded(df, LEX).first()
    assert (r.nivel, r.onde, r.trecho, r.chaves, r.categorias, r.pontuacao) == (3, "linha_fina", "a portaria 88", ["portaria", "ilha"], ["norma", "evento"], 1.5)


def _lexicon(**changes):
    return {"id": "cais", "versao": "7", "termos": [{"chave": "farol", "formas": ["farol velho"]}]} | changes


@pytest.mark.parametrize(
    ("data", "part"),
    [
        (_lexicon(contexto={}), "exige_qualquer"),
        (_lexicon(contexto=["porto"]), "contexto: must be an object"),
        (_lexicon(descricao=3), "descricao"),
        (_lexicon(termos=[{"chave": "farol", "formas": ["farol"], "nota": 1}]), "nota"),
        (_lexicon(termos=[{"chave": "farol", "formas": ["a"]}, {"chave": "farol", "formas": ["b"]}]), "repeats"),
        (_lexicon(termos=[{"chave": "farol", "formas": ["a"], "peso": False}]), "above 0"),
        (_lexicon(termos=[{"chave": "farol", "formas": ["a"], "altura": 30}]), "unknown field"),
        (_lexicon(termos=[{"chave": "farol", "formas": []}]), "at least 1"),
        (_lexicon(termos={}), "non-empty"),
        ("farol", "object"),
    ],
)
def test_bad_lexicons(data, part):
    with pytest.raises(L.LexiconError, match=part):
        L.parse(data)


def test_terms_are_looked_up():
    assert L.parse(_lexicon(contexto={"exige_qualquer": ["porto"]})).term("farol").forms == ("farol velho",)


def test_integrity(spark):
    rows = [("x" * 399,), ("x" * 400,), ("Acesso Negado" + "x" * 500,), ("Acesso negado" + "x" * 2600,), ("x" * 310 + "captcha" + "x" * 100,), (None,)]
    got = spark.createDataFrame(rows, "t string").coalesce(1).select(integrity.intact(F.col("t")).alias("ok")).collect()
    assert [r.ok for r in got] == [False, True, False, True, True, False]
