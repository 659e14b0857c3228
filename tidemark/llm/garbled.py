"""Text that was decoded with the wrong character encoding (problem 2).

Statistics: counts of adjacent character pairs around non-ASCII characters and of single characters, over all rows of
the corpus. A pair's weight is its share of the corpus mutual information, p(ab) * PMI(ab). Systematic garbling makes
pairs with a high PMI (its characters occur together only), but never ones that carry much of the information, so a
pair scores log2(LEVEL / weight): positive where the text is improbable. The maximum-scoring segments of a row (Ruzzo
and Tompa, 1999) are its suspicious stretches, and the inverse mappings are tried only inside them:

* UTF-8 read as a single-byte encoding, once or twice over: the characters encode back to well-formed UTF-8;
* one single-byte encoding read as another, which always maps back, so only the gain in likelihood decides.

A mapping is accepted when it raises the log likelihood of the stretch's pairs by at least its margin. Replacement
characters mark a row by themselves; what they stood for is lost, and the rest of the row is still restored.

Defined results: null and empty texts are no cases; rows that can't be restored come out with a null restoration.
Characters beyond the scripts named in `fold` count by block, so the pair table is bounded whatever the corpus holds.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import spread

#: Share of the mutual information of non-ASCII pairs below which a pair counts as improbable.
LEVEL = 0.01
#: What one ASCII character between two runs costs a segment, in bits.
GAP = 0.05
#: What a pair of ASCII characters in a restored run counts, in bits.
ASCII_PAIR = 6.0
#: Least gain in bits for UTF-8 mappings (well-formed sequences are evidence by themselves) and for byte swaps.
UTF8_MARGIN, SWAP_MARGIN = 4.0, 12.0

# Encodings that UTF-8 is misread in, and pairs (read in, written in) of single-byte encodings.
MISREAD = ["cp1252", "latin_1", "iso8859_15", "cp1251", "cp437", "cp850", "mac_roman", "cp1250", "cp1254", "koi8_r", "cp866", "cp1253"]
SWAPPED = [("mac_roman", "cp1252"), ("cp850", "cp1252"), ("cp437", "cp1252"), ("cp1251", "cp1252"), ("cp1250", "cp1252"), ("cp1252", "mac_roman"), ("cp1252", "cp850"), ("cp1252", "cp437")]

RUN = re.compile(r"[^\x00-\x7f]+")
LOST = "�"
#: Stands for the beginning and the end of a text in pairs.
EDGE = "\n"


def fold(ch: str) -> str:
    """The character itself in the scripts and symbol blocks of Europe, else the first of its block of 256."""
    c = ord(ch)
    if c < 0x250 or 0x370 <= c < 0x530 or 0x2000 <= c < 0x2070 or 0x20A0 <= c < 0x2150 or 0x2200 <= c < 0x2600 or c == 0xFFFD:
        return ch
    return chr(min(c, 0x2FFFF) >> 8 << 8) if not 0xD800 <= c < 0xE000 else LOST


def _pairs(text: str) -> Iterator[str]:
    for m in RUN.finditer(text):
        s = (text[m.start() - 1] if m.start() else EDGE) + text[m.start() : m.end()] + (text[m.end() : m.end() + 1] or EDGE)
        for i in range(len(s) - 1):
            yield s[i : i + 2]


def count_pairs(df: DataFrame, text: str) -> DataFrame:
    """(gram, n): pairs with a non-ASCII character, and single characters; counted per batch, then summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: Counter = Counter()
        for b in batches:
            texts = [t for t in b.column(0).to_pylist() if t]
            for t in texts:
                if not t.isascii():
                    grams.update(_pairs(t))
            codes = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
            n = np.bincount(np.minimum(codes, 0x30000))
            at = np.nonzero(n)[0]
            grams.update({chr(int(c)): int(k) for c, k in zip(at, n[at])})
        folded: Counter = Counter()
        for g, k in grams.items():
            folded["".join(map(fold, g))] += k
        yield pa.RecordBatch.from_arrays([pa.array(list(folded), pa.string()), pa.array(list(folded.values()), pa.int64())], names=["gram", "n"])

    part = spread(df.filter(df[text].isNotNull()), text).mapInArrow(run, "gram string, n long")
    return part.groupBy("gram").agg(F.sum("n").alias("n"))


class Model:
    """Pair statistics with the scoring rules, broadcast to the workers.

    Their number is bounded by the alphabet of `fold`, about 3,100 symbols with the blocks; texts of European languages
    hold a few ten thousand pairs of them.
    """

    def __init__(self, counts: dict[str, int]):
        self.total = max(1, sum(n for g, n in counts.items() if len(g) == 1))
        self.one = {EDGE: 1} | {g: n for g, n in counts.items() if len(g) == 1}
        self.two = {g: n for g, n in counts.items() if len(g) == 2}
        weight = {g: self._weight(g) for g in self.two}
        self.level = log2(LEVEL * max(sum(weight.values()), 1e-12))
        self.improbable = {g: min(self.level - log2(w), 20.0) for g, w in weight.items()}
        self._runs: dict = {}

    def _weight(self, pair: str) -> float:
        p = self.two[pair] / self.total
        pmi = log2(self.two[pair] * self.total / (self.one.get(pair[0], 1) * self.one.get(pair[1], 1)))
        return p * max(pmi, 0.1)

    def score(self, pair: str) -> float:
        return self.improbable.get("".join(map(fold, pair)), 20.0)

    def likelihood(self, text: str) -> float:
        """Sum of log2 shares of the pairs that hold a non-ASCII character; a character the corpus never has rules out."""
        total = 0.0
        for i in range(len(text) - 1):
            pair = text[i : i + 2]
            if not pair.isascii():
                pair = "".join(map(fold, pair))
                if pair[0] not in self.one or pair[1] not in self.one:
                    return -1e6
                total += log2((self.two.get(pair, 0) + 0.1) / self.total)
            else:
                total -= ASCII_PAIR
        return total

    def segments(self, text: str) -> list[tuple[int, int]]:
        """All maximal-scoring segments, as spans that begin and end with a run of non-ASCII characters."""
        scored, last = [], 0
        for m in RUN.finditer(text):
            around = (text[m.start() - 1] if m.start() else EDGE) + m.group() + (text[m.end() : m.end() + 1] or EDGE)
            pairs = [self.score(around[i : i + 2]) for i in range(len(around) - 1)]
            if scored:
                scored.append((-GAP * (m.start() - last), last, m.start()))
            scored.append((max(pairs), m.start(), m.end()))
            last = m.end()
        found: list[list[float]] = []  # start, end, sum before, sum after
        total = 0.0
        for s, lo, hi in scored:
            if s <= 0:
                total += s
                continue
            cur = [lo, hi, total, total + s]
            total += s
            while True:
                j = len(found) - 1
                while j >= 0 and found[j][2] >= cur[2]:
                    j -= 1
                if j < 0 or found[j][3] >= cur[3]:
                    found.append(cur)
                    break
                cur = [found[j][0], hi, found[j][2], cur[3]]
                del found[j:]
        return [(int(x[0]), int(x[1])) for x in found]

    def mappings(self, before: str, run: str, after: str) -> dict:
        """Inverse mappings of one run: (kind, codecs) -> (restored, gain in bits); remembered, as runs repeat."""
        key = (before, run, after)
        if key in self._runs:
            return self._runs[key]
        if len(self._runs) > 200_000:
            self._runs.clear()
        base = self.likelihood(before + run + after)
        out = {}
        for codec in MISREAD:
            text, steps = run, 0
            while steps < 3 and (fixed := _undo(text, codec)) is not None and fixed != text:
                text, steps = fixed, steps + 1
                out["utf8", codec, steps] = (text, self.likelihood(before + text + after) - base)
                if text.isascii():
                    break
        for read, written in SWAPPED:
            try:
                text = _bytes(run, read).decode(written)
            except (UnicodeError, LookupError):
                continue
            if text != run and all(c.isprintable() for c in text):
                out["swap", read, written] = (text, self.likelihood(before + text + after) - base)
        self._runs[key] = out
        return out

    def repair(self, text: str) -> tuple[str, bool]:
        """(text with accepted stretches restored, whether any was accepted)."""
        changed, out, at = False, [], 0
        for lo, hi in self.segments(text):
            sums: dict = {}
            runs = [(m.start() + lo, m.end() + lo) for m in RUN.finditer(text[lo:hi])]
            options = [self.mappings(text[a - 1] if a else EDGE, text[a:b], text[b : b + 1] or EDGE) for a, b in runs]
            for o in options:
                for k, (_, gain) in o.items():
                    if gain > 0:
                        sums[k] = sums.get(k, 0.0) + gain
            best = max(sums, key=lambda k: (sums[k] - (0 if k[0] == "utf8" else SWAP_MARGIN - UTF8_MARGIN), str(k)), default=None)
            if best is None or sums[best] < (UTF8_MARGIN if best[0] == "utf8" else SWAP_MARGIN):
                continue
            for (a, b), o in zip(runs, options):
                if best in o and o[best][1] > 0:
                    out += [text[at:a], o[best][0]]
                    at, changed = b, True
        return "".join([*out, text[at:]]) if changed else text, changed


def _bytes(text: str, codec: str) -> bytes:
    """Encode; bytes that the encoding leaves undefined were kept as C1 control characters."""
    out = bytearray()
    for ch in text:
        try:
            out += ch.encode(codec)
        except UnicodeEncodeError:
            if not 0x80 <= ord(ch) <= 0x9F:
                raise
            out.append(ord(ch))
    return bytes(out)


def _undo(text: str, codec: str) -> str | None:
    try:
        return _bytes(text, codec).decode("utf-8")
    except (UnicodeError, LookupError):
        return None


def fit(texts: DataFrame, text: str) -> Model:
    """Pair statistics of all rows. The table is bounded by the alphabet of `fold`, not by the corpus."""
    return Model({r.gram: r.n for r in count_pairs(texts, text).collect()})


def detect(df: DataFrame, text: str, model: Model | Broadcast, campo: str, key: str = "ord") -> DataFrame:
    """(campo, key, original, restored) of the garbled rows; restored is null where nothing could be mapped back."""
    shared = df.sparkSession.sparkContext.broadcast(model) if isinstance(model, Model) else model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            keep, was, now = [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                if not t or t.isascii():
                    continue
                fixed, changed = model.repair(t)
                if changed or LOST in t:
                    keep.append(i)
                    was.append(t)
                    now.append(fixed if changed else None)
            yield pa.RecordBatch.from_arrays([pa.array([campo] * len(keep), pa.string()), b.column(0).take(pa.array(keep, pa.int64())), pa.array(was, pa.string()), pa.array(now, pa.string())], names=["campo", key, "original", "restored"])

    schema = T.StructType([T.StructField("campo", T.StringType()), df.schema[key], T.StructField("original", T.StringType()), T.StructField("restored", T.StringType())])
    return spread(df.filter(df[text].isNotNull()), key, text).mapInArrow(run, schema)


def found(items: DataFrame, judged: DataFrame) -> DataFrame:
    """Garbled itens.titulo and pede_juizo.trecho, scored with the statistics of both."""
    both = items.select(F.col("titulo").alias("t")).unionByName(judged.select(F.col("trecho").alias("t")))
    model = items.sparkSession.sparkContext.broadcast(fit(both, "t"))
    return detect(items, "titulo", model, "titulo").unionByName(detect(judged, "trecho", model, "trecho"))
