"""Word shingles, minwise signatures and Hamming fingerprints, shared by the near-duplicate operators.

Words are the maximal runs of letters and digits of the lower-cased text; a text's shingles are its sets of three
consecutive words (TESTDATA.md fixes three words and a Jaccard index of 0.7). A signature has BANDS keys, each a hash of
ROWS minwise values, and a fingerprint of one bit per minwise value. Two texts of Jaccard index J share a band with
probability 1 - (1 - J^ROWS)^BANDS (0.9994 at 0.7, 0.99998 at 0.75), and their fingerprints differ in
BITS * (1 - J) / 2 bits on average (30 of 200 at 0.7, deviation 5), so RADIUS lies five deviations above.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import durable, spread

SHINGLE, JACCARD, MIN_WORDS = 3, 0.7, 50
ROWS, BANDS = 5, 40
BITS = ROWS * BANDS
RADIUS = 56
#: Candidates of one text that are verified under one key.
HUB = 256
#: Words a worker's memo may hold before it is emptied.
MEMO = 500_000

WORD = re.compile(r"[^\W_]+")
_memo: dict[str, int] = {}
_rng = np.random.default_rng(20240107)
_MUL = (_rng.integers(0, 2**32, BITS, dtype=np.uint64) | 1).astype(np.uint32)
_ADD = _rng.integers(0, 2**32, BITS, dtype=np.uint64).astype(np.uint32)
_MIX = _rng.integers(0, 2**63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)


def _word_hash(words: set[str]) -> None:
    if len(_memo) + len(words) > MEMO:
        _memo.clear()
    for w in words:
        if w not in _memo:
            _memo[w] = xxhash.xxh3_64_intdigest(w)


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of all shingles in order, first position of each text, number of words of each text)."""
    words = [WORD.findall(t.lower()) if t else [] for t in texts]
    for part in words:
        if not _memo.keys() >= (u := set(part)):
            _word_hash(u)
    n = np.fromiter(map(len, words), np.int64, len(words))
    h = np.fromiter((_hash(w) for part in words for w in part), np.uint64, int(n.sum()))
    if len(h) < SHINGLE:
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64), n
    with np.errstate(over="ignore"):
        s = h[:-2] * np.uint64(0x9E3779B97F4A7C15) + np.bitwise_xor(h[1:-1], h[1:-1] >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) + h[2:] * np.uint64(0x94D049BB133111EB)
        s ^= s >> np.uint64(32)
        s *= np.uint64(0xD6E8FEB86659FD93)
        s ^= s >> np.uint64(29)
    owner = np.repeat(np.arange(len(texts)), n)
    inside = owner[:-2] == owner[2:]
    s = s[inside]
    sizes = np.maximum(n - (SHINGLE - 1), 0)
    return s, np.cumsum(sizes) - sizes, n


def _hash(w: str) -> int:
    x = _memo.get(w)
    if x is None:
        x = _memo[w] = xxhash.xxh3_64_intdigest(w)
    return x


def signatures(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows with at least MIN_WORDS words, their band keys, their fingerprints as four 64-bit words)."""
    s, first, n = shingles(texts)
    rows = np.nonzero(n >= MIN_WORDS)[0]
    if not len(rows):
        return rows, np.empty((0, BANDS), np.int64), np.empty((0, 4), np.int64)
    # reduceat takes each start up to the next one; short texts in between are cut out first
    sizes = np.maximum(n - (SHINGLE - 1), 0)
    if len(rows) < len(n):
        s = s[np.repeat(n >= MIN_WORDS, sizes)]
    starts = np.concatenate(([0], np.cumsum(sizes[rows])[:-1]))
    low = (s >> np.uint64(32)).astype(np.uint32)
    mins = np.empty((BITS, len(rows)), np.uint32)
    buf = np.empty_like(low)
    with np.errstate(over="ignore"):
        for k in range(BITS):
            np.multiply(low, _MUL[k], out=buf)
            np.add(buf, _ADD[k], out=buf)
            mins[k] = np.minimum.reduceat(buf, starts)
        keys = np.empty((len(rows), BANDS), np.uint64)
        for b in range(BANDS):
            acc = np.full(len(rows), b + 1, np.uint64)
            for r in range(ROWS):
                acc = (acc ^ mins[b * ROWS + r].astype(np.uint64)) * _MIX[b, r]
                acc ^= acc >> np.uint64(31)
            keys[:, b] = acc
        bits = (mins * np.uint32(0x9E3779B1)) >> np.uint32(31)
    packed = np.zeros((len(rows), 32), np.uint8)
    packed[:, : BITS // 8] = np.packbits(bits.astype(np.uint8).T, axis=1)
    return rows, keys.view(np.int64), packed.view(np.int64)


def sign(df: DataFrame, keep: list[str], text: str) -> DataFrame:
    """(keep..., f0..f3, keys) of every row; null texts and those under MIN_WORDS words have null f0..f3 and no keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            rows, keys, fp = signatures(b.column(len(keep)).to_pylist())
            has = np.zeros(n, bool)
            has[rows] = True
            at = np.zeros((n, 4), np.int64)
            at[rows] = fp
            bounds = pa.array(np.concatenate(([0], np.cumsum(has * BANDS))).astype(np.int32))
            cols = [*(b.column(i) for i in range(len(keep))), *(pa.array(np.ascontiguousarray(at[:, i]), mask=~has) for i in range(4)), pa.ListArray.from_arrays(bounds, pa.array(keys.reshape(-1)))]
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, "f0", "f1", "f2", "f3", "keys"])

    schema = T.StructType([*(df.schema[k] for k in keep), *(T.StructField(f"f{i}", T.LongType()) for i in range(4)), T.StructField("keys", T.ArrayType(T.LongType()))])
    return spread(df, *keep, text).mapInArrow(run, schema)


def hamming(a: str, b: str) -> Column:
    """Differing fingerprint bits of two aliased relations; compiled into the join."""
    parts = [F.bit_count(F.col(f"{a}.f{i}").bitwiseXOR(F.col(f"{b}.f{i}"))) for i in range(4)]
    return parts[0] + parts[1] + parts[2] + parts[3]


def jaccard(a: list[str], b: list[str]) -> np.ndarray:
    """Exact Jaccard index of the shingle sets of a[i] and b[i]; -1 where either has fewer than MIN_WORDS words."""
    out = np.full(len(a), -1.0)
    texts = list(dict.fromkeys([*a, *b]))
    s, first, n = shingles(texts)
    sets: dict[str, np.ndarray] = {t: np.unique(s[f : f + max(m - 2, 0)]) for t, f, m in zip(texts, first, n) if m >= MIN_WORDS}
    for i, (x, y) in enumerate(zip(a, b)):
        if x in sets and y in sets:
            u, v = sets[x], sets[y]
            both = len(np.intersect1d(u, v, assume_unique=True))
            out[i] = both / (len(u) + len(v) - both)
    return out


def verified(pairs: DataFrame, left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """Those pairs (a, b) whose texts are similar; left and right have (id, t) of the texts of a and b, ids unique in each.

    Only texts of candidate rows travel. Of a pair, the text with fewer candidates is sent along with it; the other one
    is sent once for every HUB of its pairs, so a text with many candidates isn't copied to each of them under one key.
    """
    second = 0 if left is right else 1
    ends = pairs.select(F.explode(F.array(F.struct(F.lit(0).alias("s"), F.col(a).alias("i")), F.struct(F.lit(second).alias("s"), F.col(b).alias("i")))).alias("e"))
    degree = durable(ends.groupBy("e.s", "e.i").agg(F.count("*").alias("n")), "degrees")  # read four times below
    texts = left.select(F.lit(0).alias("s"), F.col("id").alias("i"), "t")
    if second:
        texts = texts.unionByName(right.select(F.lit(1).alias("s"), F.col("id").alias("i"), "t"))
    texts = texts.join(degree, ["s", "i"])
    deg = lambda side, k: degree.filter(F.col("s") == side).select(F.col("i").alias(k), F.col("n").alias(f"_n{k}"))
    end = lambda side, k: F.struct(F.lit(side).alias("s"), F.col(k).alias("i"), F.col(f"_n{k}").alias("n"))
    both = pairs.select(a, b).join(deg(0, a), a).join(deg(second, b), b)
    turn = F.col(f"_n{b}") > F.col(f"_n{a}")
    both = both.select(a, b, F.when(turn, end(second, b)).otherwise(end(0, a)).alias("h"), F.when(turn, end(0, a)).otherwise(end(second, b)).alias("l"))
    both = both.select(a, b, F.col("h.s").alias("hs"), F.col("h.i").alias("h"), F.col("l.s").alias("ls"), F.col("l.i").alias("l"), F.pmod(F.xxhash64("l.i"), F.ceil(F.col("h.n") / HUB)).cast("int").alias("k"))
    leaf = both.join(texts.select(F.col("s").alias("ls"), F.col("i").alias("l"), F.col("t").alias("tl")), ["ls", "l"])
    hub = texts.select(F.col("s").alias("hs"), F.col("i").alias("h"), F.col("t").alias("th"), F.explode(F.sequence(F.lit(0), (F.ceil(F.col("n") / HUB) - 1).cast("int"))).alias("k"))
    full = leaf.join(hub, ["hs", "h", "k"]).select(a, b, "th", "tl")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for lo in range(0, rb.num_rows, 256):
                part = rb.slice(lo, 256)
                keep = pa.array(jaccard(part.column(2).to_pylist(), part.column(3).to_pylist()) >= JACCARD - 1e-12)
                yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), part.column(1).filter(keep)], names=[a, b])

    return full.mapInArrow(run, T.StructType([full.schema[a], full.schema[b]]))
