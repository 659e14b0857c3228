"""Named queries over the standard tables, and the SQL that gives the same rows."""

from tidemark.plans import incremental, records, texts

MODULES = [texts, records, incremental]


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
