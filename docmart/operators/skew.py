"""Fixed buckets for set-valued documents.

A document may be stored in ``buckets`` rows, a number that the caller sets
per index and that holds for every key alike; nothing is counted and no key
is treated apart.  An entry belongs to the bucket that a hash of its value
names, so repeated links change nothing.  Bucket 0 is the head: it exists for
every document and alone carries the scalar fields; other buckets exist if they
hold an entry.  With one bucket (the default) a document is one row.  Where
even a bucket of a key is too large, the entry rows (``documents.film_entries``
and the link tables) are the form to use: they are never collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 250_000


def bucket_of(value: Column, buckets: int) -> Column:
    """0 to buckets - 1, from the first 32 bits of the md5 of the value's text (null: 0)."""
    bits = F.conv(F.substring(F.md5(value.cast("string").cast("binary")), 1, 8), 16, 10).cast("long")
    return F.coalesce(F.pmod(bits, F.lit(buckets)), F.lit(0)).cast("int")


def grouped(entries: DataFrame, heads: DataFrame, key: str, value: str, buckets: int, *aggs: Column) -> DataFrame:
    """``aggs`` per (key, part), with a head (part 0) for each key of ``heads``.

    Head rows carry NULL in every other column and in ``present``, which is
    true for entries; aggregates have to skip rows that are not present.
    """
    if buckets < 1:
        raise ValueError("buckets must be at least 1")
    entries = entries.withColumn("present", F.lit(True))
    if buckets == 1:     # every key has its one row from the join with the scalar fields
        return entries.groupBy(key).agg(*aggs).withColumn("part", F.lit(0))
    parted = entries.withColumn("part", bucket_of(F.col(value), buckets)).unionByName(
        heads.select(key).withColumn("part", F.lit(0)), allowMissingColumns=True)
    return parted.groupBy(key, "part").agg(*aggs)


def tasks_for(*tables: DataFrame) -> int:
    """Tasks for a shuffle of ``tables``: a task's rows stay as few however the tables grow (their rows are counted)."""
    return max(1, -(-sum(t.count() for t in tables) // ROWS_PER_TASK))


def parts_of(heads: DataFrame, entries: DataFrame, key: str, buckets: int) -> DataFrame:
    """``heads`` (key, scalars) joined to the grouped ``entries`` (key, part, lists) of each of their parts.

    Part 0 is there for every head and alone has the scalars.  The heads are sent to all their parts, ``buckets``
    small rows for each, so the lists stay where they were collected.
    """
    scalars = [F.when(F.col("part") == 0, F.col(c)).alias(c) for c in heads.columns if c != key]
    parts = (heads.where(F.col(key).isNotNull()).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
             .select(key, "part", *scalars))
    found = entries.withColumn("_found", F.lit(True))
    return parts.join(found, [key, "part"], "left").where((F.col("part") == 0) | F.col("_found")).drop("_found")


def with_scalars(scalars: DataFrame, parts: DataFrame, buckets: int, how: str = "left") -> DataFrame:
    """Scalar fields joined to the parts of their document; beyond the head they are NULL."""
    if buckets > 1:
        how = "inner"    # each document has its head in ``parts``
    out = scalars.join(parts, "id", how).withColumn("part", F.coalesce("part", F.lit(0)))
    for c in scalars.columns:
        if c != "id":
            out = out.withColumn(c, F.when(F.col("part") == 0, F.col(c)))
    return out


def array_sizes(docs: DataFrame, array_cols: list[str], kind: str) -> DataFrame:
    """Metric rows (metric, value): the largest array per column, in one pass over the documents."""
    largest = docs.agg(*[F.max(F.size(c)).alias(c) for c in array_cols])
    return largest.select(F.inline(F.array(*[
        F.struct(F.lit(f"{kind}.{c}").alias("metric"), F.col(c).alias("value")) for c in array_cols])))
