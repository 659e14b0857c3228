"""Template residue, filler, error pages and script notices in place of content (problem 1).

One multi-pattern automaton finds all phrases (phrases.py) in a single pass over the lower-cased text. A field is residue
when the phrases cover at least COVERAGE of its letters and digits (a site's name at the end of a short field and menu
lines are left out of the count), TELLING of them by phrases that say themselves what is wrong, or when it holds an unfilled placeholder anywhere; placeholder syntax is checked only where the automaton
met one of its openers. A long text that quotes such a phrase stays far below the coverage.

Defined results: null, empty and blank fields and bare addresses are no residue; whole texts are read, however long.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.phrases import phrases
from tidemark.session import spread

COVERAGE = 0.6

#: Least share that phrases which say by themselves what is wrong need; the rest may be advice and the like around them.
TELLING = 0.1
OPENERS = ["{", "<%", "<?", "[[", "[inserir ", "[insert", "[insér", "[object object]", "__", "@@", "%(", "%"]

#: Texts whose words vary: error numbers and incident codes.
NUMBERED = re.compile(
    r"\b(?:http|erro|error|erreur|errore|fehler|fout|hata|błąd|ошибка)(?: (?:http|code|código|codice))?:? #?[1-5]\d\d\b"
    r"|\b(?:código da ocorrência|incident id|código del incidente|code d'incident|ray id|request id|reference id|support id) ?:? ?#?[0-9a-f][0-9a-f.-]{3,}"
)
#: What such a number follows.
LEADS = ["http", "erro", "erreur", "fehler", "fout", "hata", "błąd", "ошибка", "código da ocorrência", "código del incidente", "code d'incident", "incident id", "ray id", "request id", "reference id", "support id"]
#: A status code that stands beside such a phrase.
STATUS = re.compile(r"(?<![\w.,])[45]\d\d(?![\w]|[.,]\d)")
_ID = r"[A-Za-z_$][\w.]*"
PLACEHOLDER = re.compile(
    rf"\{{\{{\s*{_ID}\s*\}}\}}|\{{%\s*{_ID}\s*%\}}|<%=?\s*{_ID}\s*%>|<\?=?\s*{_ID}\s*\?>|[$#]?\{{\s*(?:{_ID}|\d+)\s*\}}|\[\[\s*{_ID}\s*\]\]|\[(?:INSERIR|INSERT|INSERTAR|INSÉRER) [^\]\n]{{1,60}}\]"
    rf"|\[object Object\]|__[A-Z][A-Z_]*[A-Z]__|@@[A-Z][A-Z_]*@@|%\({_ID}\)[sd]|%[A-Z][A-Z_]+[A-Z]%"
)
ADDRESS = re.compile(r"\s*(?:[a-z]+://)?[\w.-]+\.[a-z]{2,}(?::\d+)?(?:/\S*)?\s*", re.I)
SITE = re.compile(r"\s[-|—–]\s[^\s|—–][^|—–\n]{0,40}$")
#: A line of at least three short entries between bars is a menu; it is no content beside which phrases could be few.
MENU = re.compile(r"^(?:[^|\n]{1,30}\|){2,}[^|\n]{1,30}$", re.M)

_automata = None


def automata():
    """Two automata of phrase -> (kind, length), built once per worker: those that can decide, and the related ones, which
    are looked for only where the first met something."""
    global _automata
    if _automata is None:
        import ahocorasick

        _automata = ahocorasick.Automaton(), ahocorasick.Automaton()
        known = phrases()
        for p, kind in known.items():
            _automata[kind == "related"].add_word(p, (kind, len(p)))
        for kind, each in (("opener", OPENERS), ("lead", LEADS)):  # a lead may be a related word as well
            for p in each:
                _automata[0].add_word(p, (kind, len(p)))
        for a in _automata:
            a.make_automaton()
    return _automata


def _spans(found, low: str, end: int) -> tuple[list[tuple[int, int, str]], set[str]]:
    """(matches as (start, stop, kind) that are whole words and stop before `end`, kinds of openers and leads met)."""
    spans, signs = [], set()
    for last, (kind, n) in found.iter(low):
        start, stop = last + 1 - n, last + 1
        if kind in ("opener", "lead"):
            signs.add(kind)
        elif stop <= end and not (start and low[start].isalnum() and low[start - 1].isalnum()) and not (stop < len(low) and low[last].isalnum() and low[stop].isalnum()):
            spans.append((start, stop, kind))
    return spans, signs


def assess(text: str | None, short: bool) -> tuple[float, str | None]:
    """(coverage, kind) of a field: kind is placeholder, error, script or filler where the field is residue, else null."""
    if not text or ADDRESS.fullmatch(text):
        return 0.0, None
    low = text.lower()
    if len(low) != len(text):  # a letter that grows in lower case would shift the spans
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    if not low.isascii():
        low = low.replace("\u2019", "'").replace("\u00a0", " ")
    end = len(low)
    if short and (m := SITE.search(low)) and m.start():
        end = m.start()
    spans, signs = _spans(automata()[0], low, end)
    if "opener" in signs and PLACEHOLDER.search(text):
        return 1.0, "placeholder"
    if "lead" in signs:
        spans += [(m.start(), m.end(), "error") for m in NUMBERED.finditer(low, 0, end)]
    if not spans:
        return 0.0, None
    spans += _spans(automata()[1], low, end)[0]
    spans += [(m.start(), m.end(), "related") for m in STATUS.finditer(low, 0, end)]
    # telling phrases are counted first, so that related ones only add what they alone cover
    marks, weight = bytearray(end), {}
    for start, stop, kind in sorted(spans, key=lambda s: (s[2] == "related", s[0] - s[1])):
        n = sum(not marks[i] and low[i].isalnum() for i in range(start, stop))
        marks[start:stop] = b"\1" * (stop - start)
        weight[kind] = weight.get(kind, 0) + n
    covered = sum(weight.values())
    total = sum(c.isalnum() for c in low[:end])
    if covered < COVERAGE * total:
        total -= sum(sum(c.isalnum() for c in m.group()) for m in MENU.finditer(low, 0, end))
    related = weight.pop("related", 0)
    if not total or not weight or covered - related < TELLING * total:
        return (covered - related) / total if total else 0.0, None
    share = covered / total
    kind = max(weight, key=lambda k: (weight[k], k)).replace("lorem", "filler")
    return share, kind if share >= COVERAGE else None


def residue(df: DataFrame, field: str, key: str = "ord", short: bool = True, name: str | None = None) -> DataFrame:
    """(key, campo, kind, coverage) of the rows whose field is residue. Map-only. name: what campo says, else the field's."""
    label = name or field

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [assess(t, short) for t in b.column(1).to_pylist()]
            keep = [i for i, (_, kind) in enumerate(got) if kind]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep, pa.int64())), pa.array([label] * len(keep), pa.string()), pa.array([got[i][1] for i in keep], pa.string()), pa.array([got[i][0] for i in keep], pa.float64())], names=[key, "campo", "kind", "coverage"])

    schema = T.StructType([df.schema[key], T.StructField("campo", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("coverage", T.DoubleType())])
    return spread(df.filter(df[field].isNotNull()), key, field).mapInArrow(run, schema)


def found(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Residue in documento.texto, itens.titulo and itens.erro."""
    return residue(documents, "texto", short=False).unionByName(residue(items, "titulo")).unionByName(residue(items, "erro"))
