"""Encoding of whole corpora with a public tokenizer (problem 8), and token counts for the mixing operator.

Byte-level BPE pre-tokenisation never joins characters across a space that has a non-space on one side, so a text may
be cut at its spaces and the pieces encoded one by one. Pieces repeat far more often than texts: each worker keeps a
bounded memo of piece -> ids and hands only unseen pieces to the tokenizers library, in one batch. Texts holding a
space with white space on both sides (or before the end) are encoded whole, as the cut isn't neutral there.

Defined results: a null and an empty text have no ids (an empty list) and zero tokens; special-token strings inside a
text are ordinary text; ids equal the library's own for the whole text.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.session import spread

TOKENIZER_DIR = "/opt/tokenizers"
DEFAULT = "byte_bpe_50k.json"
#: Entries a worker's memo may hold before it is emptied (about 60 MB).
MEMO = 400_000

_INNER = re.compile(r"\s (?:\s|\Z)")
_LOADED: dict[str, "Encoder"] = {}


def byte_table() -> dict[str, int]:
    """Character of the byte-level alphabet -> byte: printable bytes map to themselves, the rest follow from U+0100."""
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    table = {chr(b): b for b in kept}
    for n, b in enumerate(b for b in range(256) if b not in set(kept)):
        table[chr(256 + n)] = b
    return table


class Encoder:
    """One tokenizer with its memo; built once per Python worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.memo: dict[str, list[int]] = {}
        self.whole = not self._cuts_at_spaces()

    def _cuts_at_spaces(self) -> bool:
        """Whether the tokenizer's own pre-tokenizer is the byte-level one with its pattern, without a prefix space, and
        nothing normalises the text before: only then do pieces between spaces give the ids of the whole text."""
        if self.tok.normalizer is not None or self.tok.pre_tokenizer is None:
            return False
        state = json.loads(self.tok.pre_tokenizer.__getstate__())
        return state.get("type") == "ByteLevel" and not state.get("add_prefix_space") and state.get("use_regex", True)

    def raw(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, texts: list[str]) -> list[list[str]]:
        pieces = [t.replace(" ", "\0 ").split("\0") for t in texts]
        unseen = set(chain.from_iterable(pieces)).difference(self.memo)
        if unseen:
            if len(self.memo) + len(unseen) > MEMO:
                self.memo.clear()
                unseen = set(chain.from_iterable(pieces))
            todo = list(unseen)
            self.memo.update(zip(todo, self.raw(todo)))
        return pieces

    def batch(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text; null and empty texts have none."""
        out: list[list[int]] = [[] for _ in texts]
        cut, whole = [], []
        for i, t in enumerate(texts):
            if t:
                (whole if self.whole or "\0" in t or _INNER.search(t) else cut).append(i)
        for lo in range(0, len(cut), 256):
            part = cut[lo : lo + 256]
            pieces, get = self._pieces([texts[i] for i in part]), self.memo.__getitem__
            for i, p in zip(part, pieces):
                out[i] = list(chain.from_iterable(map(get, p)))
        if whole:
            for i, ids in zip(whole, self.raw([texts[i] for i in whole])):
                out[i] = ids
        return out

    def offsets(self, text: str) -> tuple[list[int], list[tuple[int, int]]]:
        """Ids with half-open code-point offsets; a character split over several tokens belongs to each of them."""
        e = self.tok.encode(text, add_special_tokens=False)
        return e.ids, e.offsets

    def decode(self, ids: list[int], errors: str = "replace") -> str:
        """Reverse the byte table token by token, then read all bytes as UTF-8 at once, so split characters rejoin."""
        table = byte_table()
        return b"".join(bytes(table[c] for c in self.tok.id_to_token(i)) for i in ids).decode("utf-8", errors)


def encoder(name: str = DEFAULT, directory: str = TOKENIZER_DIR) -> Encoder:
    path = f"{directory}/{name}"
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def _lists(ids: list[list[int]]) -> pa.Array:
    sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
    flat = np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(sizes.sum()))
    bounds = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", name: str = DEFAULT, directory: str = TOKENIZER_DIR) -> DataFrame:
    """(key, ids) of every row of df. Map-only: no shuffle, one Arrow batch in memory at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(name, directory)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), _lists(enc.batch(b.column(1).to_pylist()))], names=[key, "ids"])

    schema = T.StructType([df.schema[key], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return spread(df, key, text).mapInArrow(run, schema)


def offsets(df: DataFrame, key: str = "doc_id", text: str = "text", name: str = DEFAULT, directory: str = TOKENIZER_DIR) -> DataFrame:
    """(key, inicio, fim): half-open code-point offsets of each token; a character split over tokens belongs to each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(name, directory)
        for b in batches:
            texts = b.column(1).to_pylist()
            for lo in range(0, len(texts), 64):
                spans = [e.offsets if t else [] for t, e in zip(texts[lo : lo + 64], enc.tok.encode_batch([t or "" for t in texts[lo : lo + 64]], add_special_tokens=False))]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, 64), *(_lists([[x[i] for x in s] for s in spans]) for i in (0, 1))], names=[key, "inicio", "fim"])

    schema = T.StructType([df.schema[key], *(T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("inicio", "fim"))])
    return spread(df, key, text).mapInArrow(run, schema)


def count_tokens(df: DataFrame, keys: list[str], text: str = "text", name: str = DEFAULT, directory: str = TOKENIZER_DIR) -> DataFrame:
    """(keys..., n_tokens) of every row of df; null and empty texts have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(name, directory)
        for b in batches:
            sizes = pa.array([len(x) for x in enc.batch(b.column(len(keys)).to_pylist())], type=pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keys))), sizes], names=[*keys, "n_tokens"])

    schema = T.StructType([*(df.schema[k] for k in keys), T.StructField("n_tokens", T.LongType())])
    return spread(df, *keys, text).mapInArrow(run, schema)


def round_trip(df: DataFrame, key: str = "doc_id", text: str = "text", name: str = DEFAULT, directory: str = TOKENIZER_DIR) -> DataFrame:
    """(key, n_ids, exact): whether decoding the ids gives the text back byte for byte; null decodes to the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(name, directory)
        table, known = byte_table(), {}
        for b in batches:
            texts = b.column(1).to_pylist()
            ids = enc.batch(texts)
            same = []
            for t, x in zip(texts, ids):
                for i in set(x).difference(known):
                    known[i] = bytes(table[c] for c in enc.tok.id_to_token(i))
                same.append(b"".join(map(known.__getitem__, x)) == (t or "").encode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) for x in ids], type=pa.int64()), pa.array(same)], names=[key, "n_ids", "exact"])

    schema = T.StructType([df.schema[key], T.StructField("n_ids", T.LongType()), T.StructField("exact", T.BooleanType())])
    return spread(df, key, text).mapInArrow(run, schema)
