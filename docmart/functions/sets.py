"""Set-valued aggregate and array helpers (all built-in expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TOKEN = "<null>"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def null_keeping_set(value, present: Column | None = None) -> Column:
    """Aggregate: sorted distinct values (of the rows ``present``), NULL kept (sorted last).

    ``collect_set`` drops NULLs; wrapping the value in a struct keeps it,
    because the struct itself is never NULL.  ``array_sort`` puts NULL last.
    """
    v = F.struct(_c(value).alias("v"))
    kept = v if present is None else F.when(present, v)
    return F.array_sort(F.transform(F.collect_set(kept), lambda s: s["v"]))


def sorted_set(value) -> Column:
    """Aggregate: sorted distinct non-NULL values ([] when none)."""
    return F.array_sort(F.collect_set(_c(value)))


def sorted_refs(refs: Column) -> Column:
    """Array of struct(name, id) sorted by name then id, re-shaped to struct(id, name)."""
    return F.transform(F.array_sort(refs), lambda r: F.struct(r["id"].alias("id"), r["name"].alias("name")))


def ref_names(refs: Column) -> Column:
    return F.transform(refs, lambda r: r["name"])


def empty_if_null(arr: Column, element_type: str) -> Column:
    return F.coalesce(arr, F.array().cast(f"array<{element_type}>"))


def join_refs(refs, sep: str = ",") -> Column:
    """Flatten array<struct(id,name)> to 'id:name,...' (for oracle comparison)."""
    return F.array_join(F.transform(_c(refs), lambda r: F.concat(r["id"].cast("string"), F.lit(":"), r["name"])), sep)


def join_values(arr, sep: str = ",") -> Column:
    """Flatten an array to text with NULLs shown as '<null>'."""
    return F.array_join(F.transform(_c(arr), lambda x: x.cast("string")), sep, NULL_TOKEN)
