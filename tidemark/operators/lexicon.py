"""Declarative lexicon: validation, compilation to JVM patterns, and occurrences as native expressions.

Forms match whole words of folded text. A blank in a form stands for any run of blanks; an ellipsis for up to GAP
characters without a semicolon or line end, between word boundaries. An occurrence that lies inside an exclusion of the
same term is void.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.fold import fold_text

GAP = 60
WORD = r"[\p{L}\p{N}_]"
SPACES = r"[\s\x1c-\x1f\x85\p{Z}]+"


class LexiconError(ValueError):
    """All problems of a lexicon at once."""

    def __init__(self, problems: list[str]):
        super().__init__("; ".join(problems))
        self.problems = problems


@dataclass(frozen=True)
class Term:
    key: str
    forms: tuple[str, ...]
    exclusions: tuple[str, ...] = ()
    weight: float = 1.0
    categories: tuple[str, ...] = ()
    note: str | None = None


@dataclass(frozen=True)
class Lexicon:
    id: str
    version: str
    terms: tuple[Term, ...]
    context: tuple[str, ...] = ()
    description: str | None = None

    def term(self, key: str) -> Term:
        return next(t for t in self.terms if t.key == key)


# The fields of the interchange format and what they become here.
_TERM = {"chave": "key", "formas": "forms", "exclusoes": "exclusions", "peso": "weight", "categorias": "categories", "nota": "note"}
_TOP = ("id", "versao", "descricao", "termos", "contexto", "$schema")
_CONTEXT = ("exige_qualquer", "nota")


@dataclass
class _Check:
    problems: list[str] = field(default_factory=list)

    def fields(self, where: str, data: dict, known) -> None:
        self.problems += [f"{where}: unknown field '{k}'" for k in sorted(set(data) - set(known))]

    def texts(self, where: str, value, least: int = 0) -> tuple[str, ...]:
        if not isinstance(value, list) or not all(isinstance(x, str) and x.strip() for x in value):
            self.problems.append(f"{where}: must be a list of non-blank strings")
            return ()
        if len(value) < least:
            self.problems.append(f"{where}: needs at least {least}")
        return tuple(value)

    def text(self, where: str, value) -> str:
        if not isinstance(value, str) or not value.strip():
            self.problems.append(f"{where}: must be a non-blank string")
            return ""
        return value


def parse(data) -> Lexicon:
    """A lexicon from decoded JSON; raises LexiconError with every problem found."""
    c = _Check()
    if not isinstance(data, dict):
        raise LexiconError(["the lexicon must be an object"])
    c.fields("lexicon", data, _TOP)
    name, version = c.text("id", data.get("id")), c.text("versao", data.get("versao"))
    raw = data.get("termos")
    if not isinstance(raw, list) or not raw:
        c.problems.append("termos: must be a non-empty list")
        raw = []
    terms: list[Term] = []
    for i, t in enumerate(raw):
        where = f"termos[{i}]"
        if not isinstance(t, dict):
            c.problems.append(f"{where}: must be an object")
            continue
        c.fields(where, t, _TERM)
        weight = t.get("peso", 1.0)
        if isinstance(weight, bool) or not isinstance(weight, (int, float)) or weight <= 0:
            c.problems.append(f"{where}.peso: must be a number above 0")
            weight = 1.0
        key = c.text(f"{where}.chave", t.get("chave"))
        if key and any(x.key == key for x in terms):
            c.problems.append(f"{where}.chave: '{key}' repeats")
        lists = {k: c.texts(f"{where}.{k}", t.get(k, []), least) for k, least in (("formas", 1), ("exclusoes", 0), ("categorias", 0))}
        terms.append(Term(key, lists["formas"], lists["exclusoes"], float(weight), lists["categorias"], t.get("nota")))
    for where, value in [("descricao", data.get("descricao", "")), *((f"termos[{i}].nota", t.get("nota", "")) for i, t in enumerate(raw) if isinstance(t, dict))]:
        if not isinstance(value, str):
            c.problems.append(f"{where}: must be a string")
    context = data.get("contexto")
    markers: tuple[str, ...] = ()
    if context is not None and not isinstance(context, dict):
        c.problems.append("contexto: must be an object")
    elif context is not None:  # a context that asks for nothing is a mistake
        c.fields("contexto", context, _CONTEXT)
        markers = c.texts("contexto.exige_qualquer", context.get("exige_qualquer"), 1)
    if c.problems:
        raise LexiconError(c.problems)
    return Lexicon(name, version, tuple(terms), markers, data.get("descricao"))


def load(path: str | Path) -> Lexicon:
    try:
        return parse(json.loads(Path(path).read_text(encoding="utf-8")))
    except json.JSONDecodeError as e:
        raise LexiconError([f"not JSON: {e}"]) from e


def _literal(part: str) -> str:
    quoted = [re.sub(r"([^\w\s])", r"\\\1", w, flags=re.ASCII) if w.isascii() else "\\Q" + w + "\\E" for w in part.split()]
    return SPACES.join(quoted)


def pattern(forms: tuple[str, ...], gap: int = GAP) -> str | None:
    """One JVM pattern for all forms, longer ones first; null for no forms."""
    ordered = sorted({f.strip() for f in forms}, key=lambda f: (-len(f), f))
    between = rf"(?!{WORD})[^;\n]{{0,{gap}}}?(?<!{WORD})"
    choices = [between.join(_literal(p) for p in fold_text(f).split("…") if p.strip()) for f in ordered]
    return rf"(?<!{WORD})(?:{'|'.join(choices)})(?!{WORD})" if choices else None


def spans(folded: Column, regex: str) -> Column:
    """array<struct<start,end>> of all matches, leftmost and non-overlapping, as half-open offsets in code points.

    The gaps between matches come from `split`, so lengths alone give the offsets and no row-wise code is needed.
    """
    pairs = F.arrays_zip(F.split(folded, regex, -1).alias("gap"), F.regexp_extract_all(folded, F.lit(regex), F.lit(0)).alias("hit"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        # the piece after the last match has no match of its own
        return F.when(x["hit"].isNull(), acc).otherwise(F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end")))).alias("out")))

    return F.aggregate(pairs, zero, step, lambda acc: acc["out"])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once; a lambda's free expressions would be computed anew at each of its calls."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def occurrences(folded: Column, lexicon: Lexicon) -> Column:
    """struct<valid, void>: arrays of struct<start,end,term>; valid ones in order of start, ties and void ones in term order."""
    kind = "array<struct<start:int,term:int,end:int>>"
    valid, void = [], []
    for n, term in enumerate(lexicon.terms):
        tagged = _tagged(spans(folded, pattern(term.forms)), n)
        outside = pattern(term.exclusions)
        if outside is None:
            valid.append(tagged)
        else:
            split = let(F.struct(spans(folded, outside).alias("shields"), tagged.alias("found")), _split)
            valid.append(split["valid"])
            void.append(split["void"])
    none = F.array().cast(kind)
    return F.struct(F.array_sort(F.concat(*valid) if len(valid) > 1 else valid[0]).cast(kind).alias("valid"), (F.concat(*void) if void else none).cast(kind).alias("void"))


def _tagged(found: Column, n: int) -> Column:
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(n).alias("term"), s["end"].alias("end")))


def _split(x: Column) -> Column:
    inside = lambda o: F.exists(x["shields"], lambda e: (e["start"] <= o["start"]) & (o["end"] <= e["end"]))
    return F.struct(F.filter(x["found"], lambda o: ~inside(o)).alias("valid"), F.filter(x["found"], inside).alias("void"))


def has_term(folded: Column, forms: tuple[str, ...]) -> Column:
    return folded.rlike(pattern(forms))


def in_context(folded: Column, lexicon: Lexicon) -> Column:
    """Whether a context marker occurs; true where the lexicon asks for none."""
    p = pattern(lexicon.context)
    return F.lit(True) if p is None else folded.rlike(p)
