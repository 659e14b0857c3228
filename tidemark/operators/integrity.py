"""Integrity of captured texts: long enough, and no error page in disguise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LEAST, SURE, HEAD = 400, 2500, 300
# Marks of error pages served as if all were well, and those of web archives.
ERROR_MARKS = ("página não encontrada", "pagina nao encontrada", "page not found", "404 not found", "acesso negado", "access denied", "verifique se você é humano", "are you a robot", "captcha", "just a moment")
ARCHIVE_MARKS = ("wayback machine doesn't have that page archived", "hrm. the wayback machine has not archived", "this url has been excluded from the wayback machine")


def intact(text: Column, least: int = LEAST, marks: tuple[str, ...] = ERROR_MARKS) -> Column:
    """False below `least` characters, true from SURE on, between them false where the head holds a mark; null is false."""
    head = F.lower(F.substring(text, 1, HEAD))
    marked = F.lit(False)
    for m in marks:
        marked = marked | F.contains(head, F.lit(m))
    n = F.length(text)
    return F.coalesce((n >= least) & ((n >= SURE) | ~marked), F.lit(False))


def archive_intact(text: Column, least: int = LEAST) -> Column:
    return intact(text, least, ERROR_MARKS + ARCHIVE_MARKS)


def metadata_intact(title: Column) -> Column:
    return F.coalesce(title != "", F.lit(False))
