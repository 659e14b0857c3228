"""Page boilerplate around the main body, line by line (problem 7).

Every non-blank line of a text is a node of a small graph. A classifier's log odds become its terminal capacity,
neighbouring lines are joined by smoothness edges, and lines whose page elements are alike (the same path of tags) by
stronger ones, also across a gap of a few lines. The minimum cut, found by maximum flow, separates the main body from
the furniture. The classifier is a logistic regression on hashed features of the line, its place, its neighbours and,
where there is a page, the tags around it.

Its labels come from the pages themselves, and not from names of classes or from any one site's markup: text inside
links or a navigation element is furniture; the headline and dense text (DENSE words and a full stop, outside links) are
body; a short line that stands on REPEATED pages is furniture if it is worded unlike the dense text, and body if it is
worded like it. Lines that none of these decides are labelled by the first fit, which may also turn dense text into
furniture. Each line of the sample is learned with its tags and without them, as most texts have no page. The fit takes
at most TRAIN_DOCS pages; the model is used on all texts.

Defined results: null texts have no lines; metadata records and texts that are residue have no furniture; a text
without a page is judged by its words and place alone; line numbers count from 0 over the text split at line feeds.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from itertools import chain
from math import exp
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.residue import assess
from tidemark.session import hash_sample, spread

#: Pages the classifier is fitted on, whatever their length.
TRAIN_DOCS = 2500
#: Log odds beyond which a fit decides on lines whose weak label is missing or loose.
SURE = 0.5
BITS = 16
#: Words of a line up to which each counts in full.
FULL = 24
ADJACENT, ALIKE, REACH = 0.2, 0.3, 3
#: Sources whose records carry title, abstract, kind and venue with no page around them.
METADATA = ("openalex:", "crossref:", "ia:")
#: Words from which a line of plain text is dense, and pages on which a line has to stand to count as repeated.
DENSE, REPEATED = 12, 5
#: Shares of a line's word pairs that dense text holds too, up to which it is worded unlike it, and from which like it.
UNLIKE, LIKE = 0.5, 0.8
# Elements that run inside a line, elements for navigation by their HTML definition.
INLINE = frozenset("a b i em strong span small u s mark sup sub abbr cite code time q font label".split())
NAVIGATION = frozenset("nav footer aside menu form button".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][\w-]*)([^>]*)>([^<]*)")
_VOID = {"meta", "br", "img", "link", "input", "hr", "base", "source", "wbr", "area", "col"}
_HIDDEN = {"script", "style", "title", "head", "noscript", "template"}
_KEY = re.compile(r"[^\x21-\x7e]+")
_WORD = re.compile(r"[^\W\d_]+|\d+|[|•·>©#]")
_MASK = (1 << BITS) - 1
#: Hashes a worker remembers before it forgets them all.
MEMO = 400_000
_hashes: dict[str, int] = {}


def elements(page: bytes | None) -> dict[str, list[str]]:
    """ASCII part of each block of visible text -> its places in order.

    A place is the path of tags below body, and after a bar the inline elements that hold nearly all of the text.
    """
    if not page:
        return {}
    text = page.decode("utf-16", "replace") if page[:2] in (b"\xff\xfe", b"\xfe\xff") else page.decode("latin-1")
    out: dict[str, list[str]] = {}
    stack: list[str] = []
    inline: list[str] = []
    parts: list[str] = []
    held: dict[str, int] = {}

    def close() -> None:
        if key := "".join(parts):
            whole = sorted(t for t, n in held.items() if n >= 0.8 * len(key))
            out.setdefault(key, []).append(">".join(t for t in stack if t not in ("html", "body")) + "|" + " ".join(whole))
        parts.clear()
        held.clear()

    for end, tag, _, inner in _TAG.findall(text):
        tag = tag.lower()
        if tag in INLINE:
            if not end:
                inline.append(tag)
            elif tag in inline:
                while inline.pop() != tag:
                    pass
        elif tag in _VOID:
            if tag in ("br", "hr"):
                close()
        else:
            close()
            inline.clear()
            if not end:
                stack.append(tag)
            elif tag in stack:
                while stack.pop() != tag:
                    pass
        if inner and not inner.isspace() and not (stack and stack[-1] in _HIDDEN):
            key = _KEY.sub("", html.unescape(inner) if "&" in inner else inner)
            parts.append(key)
            for t in set(inline):
                held[t] = held.get(t, 0) + len(key)
    close()
    return out


def paths(lines: list[str], page: bytes | None) -> list[str | None]:
    """The place of each line, where the page has a block with its text."""
    found = elements(page)
    if not found:
        return [None] * len(lines)
    used: dict[str, int] = {}
    out = []
    for line in lines:
        key = _KEY.sub("", line)
        places = found.get(key)
        if not places:
            out.append(None)
            continue
        n = used.get(key, 0)
        used[key] = n + 1
        out.append(places[min(n, len(places) - 1)])
    return out


def tags(place: str) -> list[int]:
    """Hashed features of a place: the whole of it, and each of its tags."""
    path, inline = place.split("|")
    return [crc32(x.encode()) & _MASK for x in (f"D{place}", *(f"d{t}" for t in {*path.split(">"), *inline.split()}))]


def _size(n: int) -> int:
    return n.bit_length()


def _ending(line: str) -> str:
    c = line[-1]
    return "." if c in ".!?…" or (c in "”\"»’)" and len(line) > 1 and line[-2] in ".!?…") else "q" if c in "”\"»" else "0" if c.isdigit() else ":" if c == ":" else "a"


#: A row of features: their buckets, how many of them at the end are words and pairs, and the weight of each of those.
Row = tuple[list[int], int, float]


def features(lines: list[str], title: str | None) -> list[Row]:
    """Hashed features of each line of a text: shape, place, neighbours, and all of its words and pairs of words.

    Beyond FULL words these weigh less, so that a long line's words have the same length as a vector.
    """
    if len(_hashes) > MEMO:
        _hashes.clear()
    known = _hashes.get
    shape = [f"{_size(len(x))}{_ending(x)}" for x in lines]
    key = _KEY.sub("", title).lower() if title else ""
    n, out = len(lines), []
    lows = [x.lower() for x in lines]
    # what stands before an early colon says what a short line is
    colons = [x.find(":", 0, 26) for x in lows]
    said = [_WORD.findall(x[:c] if c > 0 and len(x) < 160 else x) for x, c in zip(lows, colons)]
    every = list(chain.from_iterable(said))
    w = list(map(known, every))
    if None in w:
        w = [_hash(x) if h is None else h for x, h in zip(every, w)]
    codes = np.array(w, np.int64)
    singles, doubles = (codes & _MASK).tolist(), ((codes[:-1] * 31 + codes[1:] * 17) >> 7 & _MASK).tolist()
    end = 0
    for i, line in enumerate(lines):
        before, after = (shape[i - 1] if i else "^"), (shape[i + 1] if i + 1 < n else "$")
        low, colon, words = lows[i], colons[i], said[i]
        start, end = end, end + len(words)
        short = len(low) < 160
        same = len(key) > 8 and len(line) > 12 and key.startswith(_KEY.sub("", low[:240])[:60])
        bars = min(sum(map(low.count, "|•·>")), 4)
        s = shape[i]
        f = [f"s{s}", f"b{bars}{s}", f"t{same}", f"p{min(i, 5)}", f"e{min(n - 1 - i, 7)}", f"ps{min(i, 3)}{s}{same}", f"x{before}{s}", f"y{s}{after}", f"z{before}{s}{after}", f"n{min(len(words), 20)}{s[-1]}"]
        if short:
            plain = ["#" if w.isdigit() else w for w in words]
            f.append("l" + " ".join(plain[:3]))
            f.append("L" + " ".join(plain))
            if colon > 0:
                f.append("c" + low[:colon].strip())
        at = [(known(x) or _hash(x)) & _MASK for x in f]
        at += singles[start:end] + doubles[start : max(start, end - 1)]
        out.append((at, len(at) - len(f), min(1.0, (FULL / max(1, len(words))) ** 0.5)))
    return out


def _hash(x: str) -> int:
    """A hash of a feature or a word, all numbers alike; remembered, as they repeat."""
    h = _hashes[x] = crc32(b"#" if x.isdigit() else x.encode())
    return h


def _flat(rows: list[Row]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sizes, buckets, weights) of rows of features, end to end."""
    sizes = np.fromiter((len(r[0]) for r in rows), int, len(rows))
    flat = np.fromiter(chain.from_iterable(r[0] for r in rows), int, int(sizes.sum()))
    tail = np.stack((sizes - [r[1] for r in rows], [r[1] for r in rows]), 1).reshape(-1)
    return sizes, flat, np.repeat(np.stack((np.ones(len(rows)), [r[2] for r in rows]), 1).reshape(-1), tail)


class Classifier:
    """Logistic regression with Adagrad over hashed features."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    @staticmethod
    def fit(rows: list[Row], labels: np.ndarray, epochs: int = 6, rate: float = 0.3, block: int = 256) -> Classifier:
        w, g = np.zeros(1 << BITS), np.full(1 << BITS, 1e-6)
        if not rows:
            return Classifier(w.astype(np.float32))
        sizes, flat, value = _flat(rows)
        first = np.cumsum(sizes) - sizes
        rng = np.random.default_rng(7)
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for lo in range(0, len(order), block):
                part = order[lo : lo + block]
                own = np.repeat(np.arange(len(part)), sizes[part])
                place = np.arange(len(own)) + (first[part] - (np.cumsum(sizes[part]) - sizes[part]))[own]
                at, v = flat[place], value[place]
                z = np.bincount(own, w[at] * v, len(part))
                slope = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[part]
                grad = np.bincount(at, slope[own] * v, 1 << BITS) / len(part)
                hit = np.flatnonzero(grad)
                g[hit] += grad[hit] ** 2
                w[hit] -= rate * (grad[hit] / np.sqrt(g[hit]) + 1e-4 * w[hit])
        return Classifier(w.astype(np.float32))

    def odds(self, rows: list[Row]) -> np.ndarray:
        if not rows:
            return np.zeros(0)
        sizes, flat, value = _flat(rows)
        return np.add.reduceat(self.weights[flat] * value, np.cumsum(sizes) - sizes).astype(float)


def smooth_edges(places: list[str | None]) -> list[tuple[int, int, float]]:
    """Adjacent lines, and lines within REACH whose elements are alike; where there is no page, adjacency alone."""
    n, out = len(places), []
    for i in range(n - 1):
        alike = places[i] is not None and places[i] == places[i + 1]
        out.append((i, i + 1, ADJACENT + ALIKE * alike if places[i] is None or alike else ADJACENT / 2))
        if places[i] is not None:
            for j in range(i + 2, min(i + REACH, n - 1) + 1):
                if places[j] == places[i]:
                    out.append((i, j, ALIKE / 2))
    return out


def min_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Whether each node lies on the source (furniture) side of the minimum cut.

    odds > 0 is the capacity from the source, odds < 0 to the sink. A node whose own capacity exceeds all its edges is
    settled at once (its side can't change) and hands those edges to its neighbours; the rest is solved by augmenting
    along shortest paths.
    """
    n = len(odds)
    cap = list(odds)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in edges:
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    side: list[bool | None] = [None] * n
    todo = list(range(n))
    while todo:
        i = todo.pop()
        if side[i] is None and abs(cap[i]) >= sum(near[i].values()) and (cap[i] or not near[i]):
            side[i] = cap[i] > 0
            for j, w in near[i].items():
                cap[j] += w if side[i] else -w
                del near[j][i]
                todo.append(j)
            near[i] = {}
    open_ = [i for i in range(n) if side[i] is None]
    if not open_:
        return [bool(s) for s in side]
    source = [i for i in open_ if cap[i] > 0]
    while True:
        came: dict[int, int | None] = {i: None for i in source if cap[i] > 1e-12}
        queue, end = list(came), None
        for i in queue:
            if cap[i] < -1e-12:
                end = i
                break
            for j, w in near[i].items():
                if w > 1e-12 and j not in came:
                    came[j] = i
                    queue.append(j)
        if end is None:
            for i in open_:
                side[i] = i in came
            return [bool(s) for s in side]
        path = [end]
        while came[path[-1]] is not None:
            path.append(came[path[-1]])
        path.reverse()
        flow = min([cap[path[0]], -cap[end], *(near[a][b] for a, b in zip(path, path[1:]))])
        cap[path[0]] -= flow
        cap[end] += flow
        for a, b in zip(path, path[1:]):
            near[a][b] -= flow
            near[b][a] = near[b].get(a, 0.0) + flow


def split(text: str) -> tuple[list[int], list[str]]:
    """(numbers, contents) of the non-blank lines."""
    numbers, lines = [], []
    for i, x in enumerate(text.split("\n")):
        if (x := x.strip()):
            numbers.append(i)
            lines.append(x)
    return numbers, lines


def same_words(line: str) -> str:
    return re.sub(r"\b\d+\b", "#", line.lower())


def _pairs(line: str) -> list[str]:
    words = _WORD.findall(same_words(line))
    return [f"{a} {b}" for a, b in zip(words, words[1:])] or words


def weak_labels(pages: list[tuple[list[str], list[str | None], str | None]]) -> list[list[int | None]]:
    """1 for furniture, 0 for body or None for each line of pages given as (lines, places, title)."""
    held: dict[str, set] = {}
    for n, (lines, _, title) in enumerate(pages):
        for x in set(map(same_words, lines)):
            held.setdefault(x, set()).add(title or n)  # edited copies keep their title
    often = {x for x, t in held.items() if len(t) >= REPEATED}

    def linked(place: str | None) -> bool:
        if place is None:
            return False
        path, inline = place.split("|")
        return "a" in inline.split() or not NAVIGATION.isdisjoint(path.split(">"))

    def dense(line: str, place: str | None) -> bool:
        return line.count(" ") + 1 >= DENSE and _ending(line) == "." and not linked(place) and same_words(line) not in often

    seen = {x for lines, places, _ in pages for line, p in zip(lines, places) if dense(line, p) for x in _pairs(line)}
    out = []
    for lines, places, title in pages:
        own: list[int | None] = []
        for line, p in zip(lines, places):
            if linked(p):
                own.append(1)
            elif dense(line, p) or (p or "").split("|")[0].split(">")[-1] == "h1" or (title and line == title.strip()):
                own.append(0)
            elif same_words(line) in often:
                pairs = _pairs(line)
                share = sum(x in seen for x in pairs) / len(pairs) if pairs else 0.0
                own.append(1 if share <= UNLIKE else 0 if share >= LIKE else None)
            else:
                own.append(None)
        out.append(own)
    return out


def train(docs: DataFrame) -> Classifier:
    """Fit on at most TRAIN_DOCS pages in the order of a hash of their key."""
    pages = docs.filter(F.col("bruto").isNotNull() & F.col("texto").isNotNull())
    rows = hash_sample(pages.select("ord", "texto", "bruto", "titulo"), "ord", TRAIN_DOCS, docs.count(), slack=3).collect()  # bounded by TRAIN_DOCS
    return fit_pages([(r.texto, bytes(r.bruto), r.titulo) for r in rows])


def fit_pages(rows: list[tuple[str, bytes, str | None]]) -> Classifier:
    """Fit on (text, page, title) rows by their weak labels, then twice more with labels corrected by the fit before.

    Lines without a label take the fit's where it is SURE; dense text and lines worded like it may become furniture.
    """
    pages = []
    for text, page, title in rows:
        _, lines = split(text)
        pages.append((lines, paths(lines, page), title))
    feats, labels, heads = [], [], []
    for (lines, places, title), own in zip(pages, weak_labels(pages)):
        for f, y, p, line in zip(features(lines, title), own, places, lines):
            feats.append((f, p))
            labels.append(-1 if y is None else y)
            heads.append((p or "").endswith("h1|") or bool(title and line == title.strip()))
    if not feats:
        return Classifier.fit([], np.zeros(0))
    weak, heads = np.array(labels, float), np.array(heads, bool)
    bare = [f for f, _ in feats]
    tagged = [_with(f, p) for f, p in feats if p is not None]
    has = np.array([p is not None for _, p in feats], bool)
    y = weak
    for _ in range(2):
        use = y >= 0
        odds = Classifier.fit([f for f, u in zip(bare, use) if u], y[use], epochs=2).odds(bare)
        y = np.where(weak == 1, 1.0, np.where(odds > SURE, 1.0, np.where((weak == 0) | (odds < -SURE), 0.0, -1.0)))
        y[heads] = 0.0
    use = y >= 0
    return Classifier.fit([f for f, u in zip(bare, use) if u] + [f for f, u in zip(tagged, use[has]) if u], np.concatenate((y[use], y[has][use[has]])), epochs=4)


def _with(f: Row, place: str | None) -> Row:
    return f if place is None else (tags(place) + f[0], f[1], f[2])


def label(text: str | None, page: bytes | None, title: str | None, source: str | None, odds_of) -> tuple[list[int], list[bool], list[float]]:
    """(numbers of the non-blank lines, whether each is furniture, its log odds)."""
    if not text:
        return [], [], []
    numbers, lines = split(text)
    if (source or "").startswith(METADATA) or assess(text, False)[1]:
        return numbers, [False] * len(lines), [-9.0] * len(lines)
    places = paths(lines, page)
    odds = np.clip(odds_of([_with(f, p) for f, p in zip(features(lines, title), places)]), -8.0, 8.0).tolist()
    return numbers, min_cut(odds, smooth_edges(places)), odds


def _run(weights: np.ndarray, whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(weights)
        for b in batches:
            texts, pages, titles, sources = (b.column(i).to_pylist() for i in range(1, 5))
            at, line, prob, body = [], [], [], []
            for i, t in enumerate(texts):
                numbers, cut, odds = label(t, pages[i], titles[i], sources[i], model.odds)
                if whole:
                    drop = {n for n, c in zip(numbers, cut) if c}
                    body.append(None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in drop).strip("\n"))
                    line.append(len(drop))
                else:
                    for n, c, z in zip(numbers, cut, odds):
                        if c:
                            at.append(i)
                            line.append(n)
                            prob.append(1 / (1 + exp(-max(-30.0, min(30.0, z)))))
            if whole:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(body, pa.string()), pa.array(line, pa.int64())], names=["ord", "corpo", "retiradas"])
            else:
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(line, pa.int64()), pa.array(prob, pa.float64())], names=["ord", "linha", "prob"])

    return run


def furniture(docs: DataFrame) -> DataFrame:
    """(ord, linha, prob) of each line that is not main body; prob is the classifier's own, before the cut."""
    run = _run(train(docs).weights, False)
    return spread(docs.filter(F.col("texto").isNotNull()), "ord", "texto", "bruto", "titulo", "fonte").mapInArrow(run, "ord long, linha long, prob double")


def main_body(docs: DataFrame) -> DataFrame:
    """(ord, corpo, retiradas): each text without its furniture, and the number of lines taken out."""
    run = _run(train(docs).weights, True)
    return spread(docs, "ord", "texto", "bruto", "titulo", "fonte").mapInArrow(run, "ord long, corpo string, retiradas long")
