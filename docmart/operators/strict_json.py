"""Strict check of whole JSON bodies: keys that the schema does not declare, at any depth.

A body is parsed once into a VARIANT.  Level by level its containers are
exploded into (path, key, value) rows; keys are compared with those the schema
declares at that path, and only values that the schema declares as objects or
lists of objects are exploded further, so the number of levels is the schema's
depth and a body's rows are its keys.  Nothing is collected and no body is
parsed by a Python function.

An element of a list has the path of its list, and a key with dots names a path,
as in the index.  A declared object that holds a
scalar or null has no keys to check; a value below an unknown key is not
looked at, the outermost unknown key is reported.  A text that is no JSON object
is reported with the path ``<body>``; a null body has no unknown keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NOT_AN_OBJECT = "<body>"


def declared_keys(schema: T.DataType, path: str = "") -> dict[str, list[str]]:
    """For each object of the schema its path and keys; lists have the path of what they hold."""
    while isinstance(schema, T.ArrayType):
        schema = schema.elementType
    if not isinstance(schema, T.StructType):
        return {}
    out = {path: [f.name for f in schema.fields]}
    for f in schema.fields:
        out |= declared_keys(f.dataType, f"{path}.{f.name}" if path else f.name)
    return out


def _depth(schema: T.DataType) -> int:
    """Levels of containers that may hold keys: objects, and the lists around them."""
    if isinstance(schema, T.ArrayType):
        return 1 + _depth(schema.elementType) if declared_keys(schema) else 0
    if isinstance(schema, T.StructType):
        return 1 + max((_depth(f.dataType) for f in schema.fields), default=0)
    return 0


def _members(rows: DataFrame) -> DataFrame:
    """(_id, path, key, value) of what the containers hold: an object's members with their keys, a list's without."""
    held = rows.select("_id", F.col("path").alias("_parent"), F.col("value").alias("_held"))
    inside = held.lateralJoin(held.sparkSession.tvf.variant_explode(F.col("_held").outer()))
    parent, key = F.col("_parent"), F.col("key")
    path = F.when(key.isNull(), parent).when(parent == "", key).otherwise(F.concat_ws(".", parent, key))
    return inside.select("_id", path.alias("path"), "key", "value")


def unknown_keys(bodies: DataFrame, ids: str | list[str], body: str, schema: T.StructType) -> DataFrame:
    """(ids..., path): every undeclared key of every body, once."""
    ids = [ids] if isinstance(ids, str) else list(ids)
    declared = declared_keys(schema)
    known = [f"{p}.{k}" if p else k for p, keys in declared.items() for k in keys]
    rows = bodies.where(F.col(body).isNotNull()).select(
        F.struct(*ids).alias("_id"), F.lit("").alias("path"), F.try_parse_json(body).alias("value"))
    is_object = F.coalesce(F.schema_of_variant("value").startswith("OBJECT"), F.lit(False))
    found = rows.where(~is_object).select("_id", F.lit(NOT_AN_OBJECT).alias("path"))
    rows = rows.where(is_object)
    for _ in range(_depth(schema)):
        members = _members(rows)
        found = found.unionByName(members.where(F.col("key").isNotNull() & ~F.col("path").isin(known)).select("_id", "path"))
        rows = members.where(F.col("path").isin(list(declared)))
    return found.distinct().select("_id.*", "path")
