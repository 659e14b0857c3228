"""Language of texts and of the stretches of mixed texts (problem 6).

Multinomial naive Bayes over hashed character n-grams. The model is fitted on a bounded sample of rows whose label is a
known spelling of one of LANGUAGES, then once more without the rows it disagrees with, as labels are wrong in places.
The matrix of log probabilities (BUCKETS x languages) goes to the workers by broadcast; batches are scored in numpy.
Runs of non-ASCII characters become one symbol first, so a text that was garbled has the n-grams of the clean one.

Words carry the summed log probabilities of their n-grams, and the best path over words with SWITCH as the price of a
change of language cuts a text into stretches. A stretch's confidence is its posterior, with the log probabilities
divided by the number of n-gram orders, as one character is counted once in each, times how usual its likelihood is for
that language: the mean log probability of a character in the texts of the sample, with its spread over texts and words,
is what the stretch is held against. Text of a language the model doesn't know is likelier in one of LANGUAGES than in
the others, but far less likely than that language's own, and comes out with a confidence near 0.

Defined results: null and empty texts, bare addresses, and texts without a word have no language. A label in another
spelling (code with region, three letters, a name, capitals) is right.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.residue import ADDRESS, SITE, assess
from tidemark.session import hash_sample, spread

LANGUAGES = ("pt", "en", "es", "fr")
# Spellings of language labels, in lower case and without region.
SPELLINGS = {
    "pt": "pt por portuguese português portugues portugués portugais",
    "en": "en eng english inglês ingles inglés anglais",
    "es": "es spa esp spanish español espanol espanhol espagnol castellano",
    "fr": "fr fra fre french français francais francês frances francés",
}
BITS = 18
ORDERS = (2, 3, 4)
#: Rows of the sample the classifier is fitted on.
TRAIN_ROWS = 40_000
#: Price of a change of language, in nats, and the least number of words a stretch needs.
SWITCH, LEAST_WORDS = 20.0, 5
#: Deviations below a language's usual likelihood at which the confidence halves.
FAR = 5.0

_KNOWN = {s: k for k, v in SPELLINGS.items() for s in v.split()}
_FOREIGN = re.compile(r"[^\x00-\x7f]+")
_OTHER = re.compile(r"[^A-Za-z\x01]+")
#: Share of its evidence that a capitalised word keeps: names of people and places say little about the language.
NAME_WEIGHT = 0.3


def known_label(label: Column) -> Column:
    """The language a label names, or null for none, an unknown one or another language."""
    base = F.regexp_replace(F.lower(F.trim(label)), "[-_ (].*$", "")
    pairs = [F.lit(x) for kv in _KNOWN.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), base)


def prepare(text: str) -> str:
    """One symbol for each run of non-ASCII characters, single spaces between words; case is kept for `grams`."""
    return _OTHER.sub(" ", _FOREIGN.sub("\x01", text)).strip()


def grams(plain: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(codes of the joined texts as given, bucket of the lower-case n-gram that ends at each position, by order)."""
    given = np.frombuffer((" " * max(ORDERS) + " ".join(plain) + " ").encode("latin-1"), np.uint8)
    codes = given + (((given >= 65) & (given <= 90)) * np.uint8(32))
    wide = codes.astype(np.uint32)
    at = np.empty((len(ORDERS), len(codes)), np.uint32)
    h = wide.copy()
    for n in range(2, max(ORDERS) + 1):
        h[n - 1 :] = (h[n - 2 : -1] if n == 2 else h[n - 2 : -1]) * np.uint32(256) + wide[n - 1 :]
        if n in ORDERS:
            at[ORDERS.index(n)] = ((h ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)
    return given, at


class Classifier:
    def __init__(self, table: np.ndarray, usual: np.ndarray | None = None):
        self.table = table  # (2 ** BITS, languages), float32
        # mean log probability of a character, its deviation over texts, and over single words; one row per language
        self.usual = np.tile([0.0, np.inf, np.inf], (len(LANGUAGES), 1)) if usual is None else usual

    @staticmethod
    def fit(texts: list[str], labels: np.ndarray, rounds: int = 2) -> Classifier:
        plain = [prepare(t) for t in texts]
        keep = np.array([bool(p) for p in plain], bool)
        model = None
        for _ in range(rounds):
            counts = np.full((2**BITS, len(LANGUAGES)), 0.0)
            for k in range(len(LANGUAGES)):
                rows = [plain[i] for i in np.nonzero(keep & (labels == k))[0]]
                if rows:
                    counts[:, k] = np.bincount(grams(rows)[1].reshape(-1), minlength=2**BITS)
            total = counts.sum(axis=0)
            model = Classifier(np.log((counts + 0.5) / (total + 0.5 * 4096)).astype(np.float32))
            scores = model.totals(plain)
            keep &= scores.argmax(axis=1) == labels
        model.usual = model.habits([plain[i] for i in np.nonzero(keep)[0]], labels[keep])
        return model

    def habits(self, plain: list[str], labels: np.ndarray) -> np.ndarray:
        out = np.tile([0.0, np.inf, np.inf], (len(LANGUAGES), 1))
        if not plain:
            return out
        score, owner, size = self.words(plain)
        own = score[np.arange(len(score)), labels[owner]]
        n, total, words = (np.bincount(owner, x, len(plain)) for x in (size, own, np.ones(len(own))))
        for k in range(len(LANGUAGES)):
            texts = np.nonzero((labels == k) & (n > 0))[0]
            if len(texts) < 2:
                continue
            mean = total[texts].sum() / n[texts].sum()
            mine = labels[owner] == k
            word = ((own[mine] - mean * size[mine]) ** 2).sum() / size[mine].sum()  # variance a character, over words
            text = ((total[texts] / n[texts] - mean) ** 2).mean() - (word / n[texts]).mean()
            out[k] = mean, np.sqrt(max(text, 0.0)), np.sqrt(word)
        return out

    def usualness(self, k: int, total: float, size: float) -> float:
        """About 1 for a likelihood usual in language k, near 0 for one far below."""
        mean, text, word = self.usual[k]
        if not np.isfinite(text) or size <= 0:
            return 1.0
        z = (total / size - mean) / max(1e-9, np.hypot(text, word / np.sqrt(size)))
        return float(1 / (1 + np.exp(np.clip(-2 * (z + FAR), -30, 30))))

    def totals(self, plain: list[str]) -> np.ndarray:
        out = np.zeros((len(plain), len(LANGUAGES)))
        for lo in range(0, len(plain), 2048):
            words, owner, _ = self.words(plain[lo : lo + 2048])
            np.add.at(out[lo : lo + 2048], owner, words)
        return out

    def words(self, plain: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(scores of each word, index of its text, its length as far as it counts) over a batch."""
        codes, at = grams(plain)
        per = self.table[at[0]]
        for a in at[1:]:
            per += self.table[a]
        space = codes == 32
        ends = np.nonzero(space[1:] & ~space[:-1])[0] + 1  # the space after a word, whose n-grams belong to it
        starts = np.nonzero(~space[1:] & space[:-1])[0] + 1
        total = np.concatenate((np.zeros((1, len(LANGUAGES)), np.float64), np.cumsum(per, axis=0, dtype=np.float64)))
        score = total[ends + 1] - total[starts]
        named = (codes[starts] >= 65) & (codes[starts] <= 90) & (codes[np.minimum(starts + 1, len(codes) - 1)] >= 97)
        score[named] *= NAME_WEIGHT
        size = (ends + 1 - starts) * np.where(named, NAME_WEIGHT, 1.0)
        owner = np.repeat(np.arange(len(plain)), [p.count(" ") + 1 if p else 0 for p in plain])
        return score, owner, size

    def stretches(self, plain: list[str]) -> list[list[tuple[int, int, int, float]]]:
        """For each text its stretches (language, first word, words, confidence); the best path over its words."""
        score, owner, size = self.words(plain)
        n = np.bincount(owner, minlength=len(plain)) if len(owner) else np.zeros(len(plain), int)
        first = np.cumsum(n) - n
        out: list[list] = [[] for _ in plain]
        order = np.argsort(n, kind="stable")
        order = order[n[order] > 0]
        at = 0
        while at < len(order):
            # texts of like length together, so that padding stays below a factor of two
            longest = max(16, 2 * int(n[order[at]]))
            stop = min(int(np.searchsorted(n[order], longest, side="right")), at + max(1, 2_000_000 // longest))
            rows = order[at : max(stop, at + 1)]
            at += len(rows)
            self._path(rows, n, first, score, size, out)
        return out

    def _path(self, rows, n, first, score, size, out) -> None:
        width, k = int(n[rows].max()), len(LANGUAGES)
        best = np.zeros((len(rows), k))
        back = np.zeros((width, len(rows), k), np.int8)
        for t in range(width):
            live = n[rows] > t
            s = np.zeros((len(rows), k))
            s[live] = score[first[rows[live]] + t]
            top = best.argmax(axis=1)
            switch = best[np.arange(len(rows)), top] - SWITCH
            stay = best >= switch[:, None]
            back[t] = np.where(stay | ~live[:, None], np.arange(k), top[:, None])
            best = np.where(stay | ~live[:, None], best, switch[:, None]) + s
        lang = np.zeros((width, len(rows)), np.int8)
        cur = best.argmax(axis=1)
        for t in range(width - 1, -1, -1):
            lang[t] = cur
            cur = back[t, np.arange(len(rows)), cur]
        for j, row in enumerate(rows):
            m = int(n[row])
            path = lang[:m, j]
            cuts = [0, *(np.nonzero(np.diff(path))[0] + 1).tolist(), m]
            for lo, hi in zip(cuts, cuts[1:]):
                k, at = int(path[lo]), slice(first[row] + lo, first[row] + hi)
                total = score[at].sum(axis=0)
                p = np.exp((total - total.max()) / len(ORDERS))
                out[row].append((k, lo, hi - lo, float(p[k] / p.sum()) * self.usualness(k, float(total[k]), float(size[at].sum()))))


def languages(stretches: list[tuple[int, int, int, float]]) -> dict[str, float]:
    """Languages of a text with the confidence of their longest stretch; short stretches beside longer ones don't count."""
    got: dict[str, tuple[int, float]] = {}
    for k, _, words, conf in stretches:
        if words >= LEAST_WORDS or len(stretches) == 1:
            name = LANGUAGES[k]
            if name not in got or got[name][0] < words:
                got[name] = (words, conf)
    if not got and stretches:
        k, _, words, conf = max(stretches, key=lambda s: s[2])
        got[LANGUAGES[k]] = (words, conf)
    return {k: v[1] for k, v in got.items()}


def train(rows: DataFrame, text: str, label: str, key: str) -> Classifier:
    """Fit on at most TRAIN_ROWS rows with a known label, in the order of a hash of their key."""
    known = rows.select(key, F.col(text).alias("t"), known_label(F.col(label)).alias("l")).filter("t is not null and l is not null")
    sample = hash_sample(known, key, TRAIN_ROWS, rows.count(), slack=1.5).collect()  # bounded by TRAIN_ROWS
    return Classifier.fit([r.t for r in sample], np.array([LANGUAGES.index(r.l) for r in sample], int))


def identify(df: DataFrame, text: str, label: str, campo: str, shared, headline: bool, key: str = "ord") -> DataFrame:
    """(campo, key, label, idioma, confianca, inicio, palavras, conta): one row for each stretch of each text.

    conta: whether the stretch counts as a language of the text; a short one beside longer ones doesn't, as these are
    mostly pieces of cut words and names, with a high confidence too. Titles lose a site name at their end, and titles that are residue don't count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(*shared.value)
        for b in batches:
            plain = []
            for t in b.column(2).to_pylist():
                if not t or ADDRESS.fullmatch(t) or (headline and assess(t, True)[1]):
                    plain.append("")
                    continue
                if headline and (m := SITE.search(t)) and m.start():
                    t = t[: m.start()]
                plain.append(prepare(t))
            at, lang, conf, start, words, counts = [], [], [], [], [], []
            for i, s in enumerate(model.stretches(plain)):
                named = languages(s)
                for k, lo, n, c in s:
                    at.append(i)
                    lang.append(LANGUAGES[k])
                    conf.append(c)
                    start.append(lo)
                    words.append(n)
                    counts.append(LANGUAGES[k] in named and (n >= LEAST_WORDS or len(named) == 1))
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([campo] * len(at), pa.string()), b.column(0).take(take), b.column(1).take(take), pa.array(lang, pa.string()), pa.array(conf, pa.float64()), pa.array(start, pa.int32()), pa.array(words, pa.int32()), pa.array(counts, pa.bool_())],
                names=["campo", key, "rotulo", "idioma", "confianca", "inicio", "palavras", "conta"],
            )

    schema = T.StructType([T.StructField("campo", T.StringType()), df.schema[key], T.StructField("rotulo", T.StringType()), T.StructField("idioma", T.StringType()), T.StructField("confianca", T.DoubleType()), T.StructField("inicio", T.IntegerType()), T.StructField("palavras", T.IntegerType()), T.StructField("conta", T.BooleanType())])
    src = df.filter(F.col(text).isNotNull()).select(key, known_label(F.col(label)).alias("rotulo"), text)
    return spread(src).mapInArrow(run, schema)


def stretches(items: DataFrame, judged: DataFrame) -> DataFrame:
    """All stretches of itens.titulo and pede_juizo.trecho, short ones included."""
    t = items.select("ord", "idioma", F.col("titulo").alias("t")).unionByName(judged.select("ord", "idioma", F.col("trecho").alias("t")))
    model = train(t, "t", "idioma", "ord")
    shared = items.sparkSession.sparkContext.broadcast((model.table, model.usual))  # 2 ** BITS rows, fixed
    return identify(items, "titulo", "idioma", "titulo", shared, True).unionByName(identify(judged, "trecho", "idioma", "trecho", shared, False))


def found(items: DataFrame, judged: DataFrame) -> DataFrame:
    """(campo, ord, idioma): languages of texts that are mixed or whose label is missing or wrong. ord is unique by field."""
    per = stretches(items, judged).filter("conta").groupBy("campo", "ord").agg(F.first("rotulo").alias("rotulo"), F.collect_set("idioma").alias("all"))
    wrong = (F.size("all") > 1) | ~F.col("rotulo").eqNullSafe(F.col("all")[0])
    return per.filter(wrong).select("campo", "ord", F.explode("all").alias("idioma"))
