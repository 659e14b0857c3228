"""Abusive, hateful or sexual passages, by their nearest labelled examples (problem 10).

A document is cut into passages at sentence ends, colons and line ends. Passages are TF-IDF vectors over hashed words;
the inverse document frequencies come from the passages of all documents. Words are normalised first: accents, letters
written as digits, letters drawn out or spaced out. Examples are the passages of at most LABELLED labelled documents.

A positive document's ordinary passages are no examples of abuse: those whose weight lies mostly on words that are no
more usual in positive documents than elsewhere are left out, by the labels and by how much of what all documents hold
of these words stands in labelled positive ones: a site's name is met far more often outside. The examples stand in an inverted index in blocks of alike ones, with
the greatest weight of each word in each block. A passage's bound over a block is the sum of its own weights times these
maxima, so no example of a block with a lower bound can be nearer. Of a passage's K nearest examples those with a cosine
of NEAR or more vote, with the POWER of the cosine (the kernel ends there, so farther ones have no weight and needn't be
searched for); SILENT adds the weight of a silent negative vote. A passage without an abusive example within NEAR
therefore scores 0, which the bounds show for most passages without a cosine being computed. The score of a
document is that of its worst passage, which comes with it as evidence; scores are mapped to rates by the labelled
documents scored without their own examples.

Defined results: null and empty texts score 0 without evidence; of passages that score alike the first is the evidence;
several labels of one document count as one, by majority and abusive on a tie; without positive labels all score 0.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import hash_sample, spread

LABELLED = 4000
BITS = 18
K, POWER, SILENT = 9, 6, 0.02
#: Least cosine of an example that votes.
NEAR = 0.45
#: Share of abusive documents a passage of a positive document needs, by weight of its words, to be an example.
PURE = 0.4
BLOCK = 16
#: Rounding of sums of single-precision weights, by which bounds are loosened.
SLACK = 1e-5
#: Least part of the median example's share of its words' occurrences in all documents that stands in positive ones.
HELD = 0.2
#: Score from which a document counts as found.
FOUND = 0.5
MEMO = 400_000
#: Tasks a core that count words.
TASKS = 4

_TOKEN = re.compile(r"[^\W_]+(?:[*@$][^\W_]*)*|[.!?:…]")
_SPACED = re.compile(r"(?<![^\W_])[^\W\d_](?:[ .\-_*][^\W\d_]){3,}(?![^\W_])")
_DRAWN = re.compile(r"(.)\1{2,}")
_DIGITS = str.maketrans("431057@$", "aeiostas")
_MASK = (1 << BITS) - 1
END, NUMBER = -1, 7
_memo: dict[str, tuple[int, ...]] = {}


def normal(word: str) -> str:
    """Lower case without accents; digits among letters read as letters, drawn-out letters once."""
    w = word.lower()
    if not w.isascii():
        w = "".join(c for c in unicodedata.normalize("NFD", w) if not unicodedata.combining(c))
    if not w.isalpha() and not w.isdigit():
        w = w.translate(_DIGITS)
    return _DRAWN.sub(r"\1", w)


def _buckets(chunk: str) -> tuple[int, ...]:
    """Buckets of the words of a piece between blanks, END where a passage ends; pieces repeat, so they are remembered."""
    out = []
    for token in _TOKEN.findall(joined(chunk)):
        if token in ".!?:…":
            out.append(END)
        else:
            w = normal(token)
            out.append(NUMBER if w.isdigit() else crc32(w.encode()) & _MASK)
    return tuple(out)


def joined(text: str) -> str:
    """Letters spaced out one by one become a word again."""
    return _SPACED.sub(lambda m: re.sub(r"[ .\-_*]", "", m.group()), text)


def _chunks(text: str) -> list[str]:
    return text.replace("\n", " … ").split()


def pieces(texts: list[str | None]) -> list[list[str]]:
    """The pieces between blanks of each text, line ends as one of their own."""
    out = [_chunks(t) if t else [] for t in texts]
    sizes = np.fromiter(map(len, out), np.int64, len(out))
    single = np.fromiter((len(c) == 1 for c in chain.from_iterable(out)), bool, int(sizes.sum()))
    four = np.nonzero(single[:-3] & single[1:-2] & single[2:-1] & single[3:])[0] if len(single) > 3 else ()
    for i in np.unique(np.searchsorted(np.cumsum(sizes), four, "right")) if len(four) else ():
        out[i] = _chunks(joined(texts[i]))
    return out


class Passages:
    """Distinct words of each passage of a batch: CSR over (passage, bucket) with counts."""

    def __init__(self, texts: list[str | None]):
        self.chunks = pieces(texts)
        flat = list(chain.from_iterable(self.chunks))
        unseen = set(flat).difference(_memo)
        if len(_memo) + len(unseen) > MEMO:
            _memo.clear()
            unseen = set(flat)
        _memo.update((c, _buckets(c)) for c in unseen)
        sizes = np.fromiter(map(len, self.chunks), np.int64, len(texts))
        self.start = np.concatenate(([0], np.cumsum(sizes)))
        got = list(map(_memo.__getitem__, flat))
        per = np.fromiter(map(len, got), np.int64, len(got))
        ids = np.fromiter(chain.from_iterable(got), np.int32, int(per.sum()))
        chunk = np.repeat(np.arange(len(flat)), per)
        owner = np.repeat(np.arange(len(texts)), sizes)[chunk]
        new = np.empty(len(ids), bool)
        if len(ids):
            new[0] = True
            new[1:] = (ids[:-1] == END) | (owner[1:] != owner[:-1])
        number = np.cumsum(new) - 1
        real = ids != END
        at = np.nonzero(new)[0]  # first token of each passage
        self.owner, self.chunk = owner[at], chunk[at]
        self.count = len(at)
        key = np.sort(number[real].astype(np.int64) << BITS | ids[real])
        cut = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.empty(0, bool)
        tf = np.diff(np.concatenate((np.nonzero(cut)[0], [len(key)])))
        key = key[cut]
        self.passage, self.bucket, self.tf = key >> BITS, (key & _MASK).astype(np.int32), tf
        self.size = np.bincount(self.passage, minlength=self.count)
        self.first = np.cumsum(self.size) - self.size

    def text(self, p: int) -> str:
        """A passage as written, up to the blanks around it."""
        o = int(self.owner[p])
        lo, base = int(self.chunk[p]), int(self.start[o])
        hi = int(self.chunk[p + 1]) if p + 1 < self.count and self.owner[p + 1] == o else int(self.start[o + 1])
        return " ".join(w for w in self.chunks[o][lo - base : max(hi, lo + 1) - base] if w != "…")

    def weights(self, idf: np.ndarray) -> np.ndarray:
        """Unit-length TF-IDF weights of all entries."""
        w = (1 + np.log(self.tf)) * idf[self.bucket]
        norm = np.sqrt(np.bincount(self.passage, w * w, self.count))
        return w / np.maximum(norm, 1e-12)[self.passage]


def frequencies(docs: DataFrame, text: str) -> DataFrame:
    """(bucket, n): passages that hold a word, by bucket; bucket -1 counts all.

    A task sends a row for each bucket it met, so a large input is read by TASKS tasks a core and not by one for each of
    its splits: the rows shuffled depend on the cluster, not on the data.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(1 << BITS, np.int64), 0
        for b in batches:
            p = Passages(b.column(0).to_pylist())
            n += np.bincount(p.bucket, minlength=1 << BITS)
            total += int((p.size > 0).sum())
        at = np.nonzero(n)[0]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(([-1], at)), pa.int32()), pa.array(np.concatenate(([total], n[at])), pa.int64())], names=["bucket", "n"])

    src = spread(docs.filter(F.col(text).isNotNull()), text)
    part = src.coalesce(TASKS * max(2, docs.sparkSession.sparkContext.defaultParallelism)).mapInArrow(run, "bucket int, n long")
    return part.groupBy("bucket").agg(F.sum("n").alias("n"))


def idf_of(counts: list[tuple[int, int]]) -> np.ndarray:
    n, total = np.zeros(1 << BITS), 1
    for b, k in counts:
        if b < 0:
            total = max(1, k)
        else:
            n[b] = k
    return np.log((total + 1) / (n + 1)).astype(np.float64)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for each range, end to end."""
    size = size.astype(np.int64)
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


class Index:
    """Labelled examples in blocks, with block maxima; its size is in proportion to the examples' words, bounded by LABELLED."""

    def __init__(self, idf: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray, int, int]]):
        """rows: (buckets, weights, abusive documents, other documents) of each distinct example."""
        # abusive examples first; alike ones share blocks when sorted by their heaviest word
        rows = sorted(rows, key=lambda r: (r[2] == 0, int(r[0][np.argmax(r[1])]) if len(r[0]) else 0, r[0].tobytes()))
        self.idf = idf
        self.size = np.array([len(r[0]) for r in rows], int)
        self.first = np.concatenate(([0], np.cumsum(self.size)))
        self.bucket = np.concatenate([r[0] for r in rows]).astype(np.int32) if rows else np.empty(0, np.int32)
        self.weight = np.concatenate([r[1] for r in rows]).astype(np.float32) if rows else np.empty(0, np.float32)
        self.pos, self.neg = (np.array([r[k] for r in rows], float) for k in (2, 3))
        self.n = len(rows)
        self.n_pos = int((self.pos > 0).sum())
        block = np.repeat(np.arange(self.n) // BLOCK, self.size)
        uniq, at = np.unique(self.bucket.astype(np.int64) << 32 | block, return_inverse=True)
        peak = np.zeros(len(uniq), np.float32)
        np.maximum.at(peak, at, self.weight)
        self.blocks = -(-self.n // BLOCK)
        self.post_bucket, self.post_block, self.post_max = (uniq >> 32).astype(np.int32), (uniq & 0xFFFFFFFF).astype(np.int32), peak
        # postings of the blocks that hold abusive examples, and all of these blocks as one
        mine = self.post_block < -(-self.n_pos // BLOCK)
        self.pos_block, self.pos_max = self.post_block[mine], peak[mine]
        self.pos_start = np.searchsorted(self.post_bucket[mine], np.arange((1 << BITS) + 1)).astype(np.int32)
        self.most = np.zeros(1 << BITS, np.float32)
        np.maximum.at(self.most, self.post_bucket[mine], self.pos_max)
        self.memo: dict = {}
        self.query = np.zeros(1 << BITS, np.float32)

    def cosines(self, ids: np.ndarray) -> np.ndarray:
        """Cosines of the current query with some examples."""
        sizes = self.size[ids]
        flat = _ranges(self.first[ids], sizes)
        return np.bincount(np.repeat(np.arange(len(ids)), sizes), self.query[self.bucket[flat]] * self.weight[flat], len(ids))

    def nearest(self, bucket: np.ndarray, weight: np.ndarray, k: int = K, least: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the k nearest with a cosine above `least`, exactly: blocks are opened in the order of
        their bounds until no closed one can hold a nearer example; of equal cosines the first example wins."""
        lo = np.searchsorted(self.post_bucket, bucket, "left")
        hi = np.searchsorted(self.post_bucket, bucket, "right")
        bound = np.zeros(self.blocks)
        for a, b, w in zip(lo, hi, weight):
            if b > a:
                bound[self.post_block[a:b]] += w * self.post_max[a:b]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > least - SLACK]
        best_i, best_s = np.empty(0, int), np.empty(0)
        self.query[bucket] = weight
        step = 8
        for at in range(0, len(order), step):
            if len(best_s) == k and bound[order[at]] < best_s[-1] - SLACK:
                break
            ids = (order[at : at + step, None] * BLOCK + np.arange(BLOCK)).reshape(-1)
            ids = ids[ids < self.n]
            best_i, best_s = np.concatenate((best_i, ids)), np.concatenate((best_s, self.cosines(ids)))
            top = np.lexsort((best_i, -best_s))[:k]
            best_i, best_s = best_i[top], best_s[top]
        self.query[bucket] = 0
        keep = best_s > least
        return best_i[keep], best_s[keep]

    def vote(self, bucket: np.ndarray, weight: np.ndarray, own: int | None = None) -> float:
        """Share of abusive examples among the nearest, by POWER of the cosine. own: 1 or 0 takes one such document out of
        examples with the very same words, for scoring labelled documents themselves."""
        key = (bucket.tobytes(), weight.astype(np.float32).tobytes(), own)
        if key in self.memo:
            return self.memo[key]
        i, s = self.nearest(bucket, weight, K if own is None else K + 2, NEAR)
        pos, neg = self.pos[i].copy(), self.neg[i].copy()
        if own is not None:
            same = s > 1 - 1e-5
            (pos if own else neg)[same] -= 1
            pos, neg = np.maximum(pos, 0), np.maximum(neg, 0)
        there = pos + neg > 0
        i, s, pos, neg = i[there][:K], s[there][:K], pos[there][:K], neg[there][:K]
        w = np.minimum(s, 1.0) ** POWER
        out = float((w * pos / (pos + neg)).sum() / (w.sum() + SILENT)) if len(i) else 0.0
        if len(self.memo) > 100_000:
            self.memo.clear()
        self.memo[key] = out
        return out

    def reached(self, p: Passages, w: np.ndarray) -> np.ndarray:
        """Passages with an abusive example within NEAR: the bounds leave few blocks, whose examples are then compared."""
        bound = np.bincount(p.passage, w * self.most[p.bucket], p.count)
        maybe = np.nonzero(bound >= NEAR - SLACK)[0]
        blocks = int(self.pos_block.max()) + 1
        held = np.concatenate((p.passage << BITS | p.bucket, [np.iinfo(np.int64).max]))  # ascending
        hit = np.zeros(p.count, bool)
        for lo in range(0, len(maybe), 4096):
            part = maybe[lo : lo + 4096]
            n = p.size[part]
            at = _ranges(p.first[part], n)
            a = self.pos_start[p.bucket[at]]
            m = self.pos_start[p.bucket[at] + 1] - a
            post = _ranges(a, m)
            own = np.repeat(np.repeat(np.arange(len(part)), n), m)
            sums = np.bincount(own * blocks + self.pos_block[post], np.repeat(w[at], m) * self.pos_max[post], len(part) * blocks)
            near = np.nonzero(sums >= NEAR - SLACK)[0]
            for k in range(0, len(near), 2048):
                who, block = np.divmod(near[k : k + 2048], blocks)
                start = block * BLOCK
                count = np.minimum(start + BLOCK, self.n) - start
                ids, q = _ranges(start, count), np.repeat(part[who], count)
                sizes = self.size[ids]
                flat = _ranges(self.first[ids], sizes)
                key = np.repeat(q, sizes) << BITS | self.bucket[flat]
                place = np.searchsorted(held, key)
                product = np.where(held[place] == key, w[np.minimum(place, len(w) - 1)], 0.0) * self.weight[flat]
                cosine = np.bincount(np.repeat(np.arange(len(ids)), sizes), product, len(ids))
                hit[q[(cosine > NEAR) & (ids < self.n_pos)]] = True
        return np.nonzero(hit)[0]

    def scores(self, p: Passages, own: np.ndarray | None = None) -> np.ndarray:
        """Score of each passage of a batch."""
        w = p.weights(self.idf)
        out = np.zeros(p.count)
        if not p.count or not self.n_pos:
            return out
        for j in self.reached(p, w):
            a, b = p.first[j], p.first[j] + p.size[j]
            out[j] = self.vote(p.bucket[a:b], w[a:b], None if own is None else int(own[p.owner[j]]))
        return out


def fit(texts: list[str], labels: list[int], idf: np.ndarray) -> tuple[Index, list[tuple[float, float]]]:
    """(index, calibration steps as (score, rate)) from labelled texts."""
    y = np.array(labels, int)
    p = Passages(texts)
    w = p.weights(idf)
    abusive = y[p.owner[p.passage]] if p.count else np.empty(0, int)
    doc_word = np.unique(p.owner[p.passage].astype(np.int64) << BITS | p.bucket)
    word, of = doc_word & _MASK, y[doc_word >> BITS]
    pos = np.bincount(word[of == 1], minlength=1 << BITS)
    neg = np.bincount(word[of == 0], minlength=1 << BITS)
    prior = y.mean() if len(y) else 0.0
    # a positive document doesn't count for its own words, else any rare word would speak for abuse
    seen = pos[p.bucket] - (abusive == 1)
    rate = (seen + 2 * prior) / (seen + neg[p.bucket] + 2)
    purity = np.bincount(p.passage, w * w * rate, p.count)
    # in proportion to the share of a word's passages in all documents that positive ones explain: exp(idf) goes as 1 / n
    held = np.bincount(p.passage, w * w * pos[p.bucket] * np.exp(idf[p.bucket]), p.count)
    pure = (p.size > 0) & (y[p.owner] == 1) & (purity >= PURE) if p.count else np.empty(0, bool)
    pure[pure] = held[pure] >= HELD * np.median(held[pure]) if pure.any() else False
    rows: dict[bytes, list] = {}
    for j in range(p.count):
        if not p.size[j]:
            continue
        bad = y[p.owner[j]] == 1
        if bad and not pure[j]:
            continue
        lo, hi = p.first[j], p.first[j] + p.size[j]
        r = rows.setdefault(p.bucket[lo:hi].tobytes() + p.tf[lo:hi].tobytes(), [p.bucket[lo:hi], w[lo:hi], 0, 0])
        r[2 + (not bad)] += 1
    index = Index(idf, [tuple(r) for r in rows.values()])
    own = index.scores(p, y)
    worst = np.zeros(len(texts))
    np.maximum.at(worst, p.owner, own)
    return index, steps(worst, y)


def steps(scores: np.ndarray, y: np.ndarray) -> list[tuple[float, float]]:
    """Isotonic rates by pooling adjacent violators: (least score, rate) of each level; ties are pooled first."""
    levels: list[list[float]] = []
    for s in np.unique(np.round(scores, 3)):
        hit = np.round(scores, 3) == s
        levels.append([float(s), float(y[hit].sum()), float(hit.sum())])
        while len(levels) > 1 and levels[-2][1] / levels[-2][2] >= levels[-1][1] / levels[-1][2]:
            last = levels.pop()
            levels[-1][1] += last[1]
            levels[-1][2] += last[2]
    return [(s, k / n) for s, k, n in levels]


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, abusivo) of labelled documents with a text."""
    one = labels.filter(F.col("doc_id").isNotNull() & F.col("abusivo").isNotNull()).groupBy("doc_id").agg((F.avg("abusivo") >= 0.5).cast("int").alias("abusivo"))
    return docs.filter(F.col("text").isNotNull()).select("doc_id", "text").join(one, "doc_id")


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, source, score, rate, evidence): every document, null texts included."""
    idf = idf_of([(r.bucket, r.n) for r in frequencies(docs, "text").collect()])  # at most 2 ** BITS rows
    sample = hash_sample(labelled(docs, labels), "doc_id", LABELLED, labels.count(), slack=1.5).collect()  # bounded by LABELLED
    index, levels = fit([r.text for r in sample], [r.abusivo for r in sample], idf)
    at, rates = np.array([s for s, _ in levels] or [0.0]), np.array([r for _, r in levels] or [0.0])
    shared = docs.sparkSession.sparkContext.broadcast(index)  # bounded by LABELLED

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        for b in batches:
            texts = b.column(2).to_pylist()
            p = Passages(texts)
            s = ix.scores(p)
            worst, which = np.zeros(len(texts)), np.full(len(texts), -1)
            for j in np.nonzero(s > 0)[0]:
                o = p.owner[j]
                if s[j] > worst[o]:
                    worst[o], which[o] = s[j], j
            rate = np.where(worst > 0, rates[np.maximum(np.searchsorted(at, np.round(worst, 3), "right") - 1, 0)], rates[0])
            rate[[not t for t in texts]] = 0.0
            evidence = [p.text(j) if j >= 0 else None for j in which]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(worst), pa.array(rate), pa.array(evidence, pa.string())], names=["doc_id", "source", "score", "rate", "evidence"])

    return spread(docs, "doc_id", "source", "text").mapInArrow(run, "doc_id long, source string, score double, rate double, evidence string")


def rates(scored: DataFrame) -> DataFrame:
    """(source, n_docs, n_found, mean_rate) of each source, null included."""
    return scored.groupBy("source").agg(F.count("*").alias("n_docs"), F.count_if(F.col("score") >= FOUND).alias("n_found"), F.avg("rate").alias("mean_rate"))
