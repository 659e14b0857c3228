"""Accent- and case-folding that keeps one character per character, as a JVM `translate`."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def fold_char(ch: str) -> str:
    """First character of the lower-cased letter below the combining marks; the character itself where nothing is left."""
    bare = "".join(c for c in unicodedata.normalize("NFD", ch) if not unicodedata.combining(c)).lower()
    return bare[:1] or ch


@functools.cache
def tables() -> tuple[str, str]:
    """(from, to) over all code points that folding changes, derived from the Unicode database."""
    changed = [(ch, f) for ch in map(chr, range(0x110000)) if not 0xD800 <= ord(ch) < 0xE000 and (f := fold_char(ch)) != ch]
    return "".join(c for c, _ in changed), "".join(f for _, f in changed)


def fold(c: Column) -> Column:
    """Folded text of the same length in code points, so offsets found in it hold for the original; null stays null."""
    source, target = tables()
    return F.translate(c, source, target)


def fold_text(text: str) -> str:
    """The same for a driver-side string."""
    return "".join(map(fold_char, text))
