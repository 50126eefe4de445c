"""Admin-style text search predicates: every term must match some field."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_terms(query: str) -> list[str]:
    return [t for t in query.split() if t]


def escape_like(term: str, escape: str = "\\") -> str:
    """Escape LIKE wildcards so a user term matches literally."""
    return term.replace(escape, escape * 2).replace("%", escape + "%").replace("_", escape + "_")


def contains_ci(col: Column, term: str) -> Column:
    """Case-insensitive literal containment (NULL field -> no match)."""
    return F.coalesce(col.cast("string").ilike(f"%{escape_like(term)}%"), F.lit(False))


def all_terms_match(fields: list[str], query: str) -> Column:
    terms = split_terms(query)
    if not terms:
        return F.lit(True)
    per_term = [reduce(lambda a, b: a | b, [contains_ci(F.col(f), t) for f in fields]) for t in terms]
    return reduce(lambda a, b: a & b, per_term)
