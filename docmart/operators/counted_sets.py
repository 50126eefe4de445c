"""Sets of films per key, kept by signed counts of their links.

A link that comes adds 1 to the count of its (id, film_id), a link that goes
takes 1 away; an entry is in the set while its count is positive, so repeated
links need no special care.  A change is written as its own signed rows and
touches nothing else: the set of a hot key is neither read nor collected for it.

Each batch is one partition of the store.  A batch that is replayed
overwrites itself.  Rows are range-partitioned by (id, film_id), so the rows of a
hot key spread over files and tasks.  Links without a key or film are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .skew import bucket_of

ENTRY = ("id", "film_id")


def signed(links: DataFrame, key: str, sign: int = 1) -> DataFrame:
    """(id, film_id, n) rows of links that come (``sign`` 1) or go (-1)."""
    rows = links.select(F.col(key).alias("id"), F.col("film_work_id").alias("film_id"), F.lit(sign).cast("long").alias("n"))
    return rows.where("id is not null and film_id is not null")


def netted(rows: DataFrame) -> DataFrame:
    """One row per entry whose signed counts do not cancel out (map-side combined)."""
    return rows.groupBy(*ENTRY).agg(F.sum("n").alias("n")).where("n <> 0")


class CountedSets:
    """The store of one index at ``path``, a folder all executors share."""

    def __init__(self, spark: SparkSession, path: str, files: int = 16) -> None:
        self.spark, self.path, self.files = spark, path, files

    def append(self, rows: DataFrame, batch_id: int) -> None:
        """Write the signed rows of a batch; batches are numbered in order of time."""
        (netted(rows).repartitionByRange(self.files, *ENTRY).sortWithinPartitions(*ENTRY)
         .write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}"))

    def rows(self) -> DataFrame:
        return self.spark.read.option("basePath", self.path).parquet(self.path)

    def entries(self) -> DataFrame:
        """(id, film_id, n) of all entries that are in their set."""
        return netted(self.rows().select(*ENTRY, "n")).where("n > 0")

    def changes(self, batch_id: int) -> DataFrame:
        """(id, film_id, change): entries that a batch added to their set or retracted from it."""
        rows = self.rows()
        new = rows.where(F.col("batch_id") == batch_id).select(*ENTRY, F.col("n").alias("delta"))
        old = netted(rows.where(F.col("batch_id") < batch_id).join(new, list(ENTRY), "left_semi").select(*ENTRY, "n"))
        both = new.join(old, list(ENTRY), "left").withColumn("n", F.coalesce("n", F.lit(0)))
        was, now = F.col("n") > 0, F.col("n") + F.col("delta") > 0
        return both.where(was != now).select(*ENTRY, F.when(now, "added").otherwise("retracted").alias("change"))

    def unmatched(self) -> DataFrame:
        """(id, film_id, n): entries with more links gone than had come; the feed lost or repeated something."""
        return netted(self.rows().select(*ENTRY, "n")).where("n < 0")

    def parts(self, buckets: int, changed_in: int | None = None) -> DataFrame:
        """(id, part, film_ids): the sets in at most ``buckets`` rows a key; of those that a batch changed, if one is given.

        A part that lost its last entry has an empty list, so an index can remove it.
        """
        part = bucket_of(F.col("film_id"), buckets).alias("part")
        entries = self.entries().select("id", part, "film_id")
        if changed_in is None:
            return entries.groupBy("id", "part").agg(F.sort_array(F.collect_list("film_id")).alias("film_ids"))
        touched = self.changes(changed_in).select("id", part).distinct()
        return (entries.join(touched, ["id", "part"], "left_semi").unionByName(touched, allowMissingColumns=True)
                .groupBy("id", "part").agg(F.sort_array(F.collect_list("film_id")).alias("film_ids")))

    def compacted(self, path: str, upto: int) -> "CountedSets":
        """A store at ``path`` with all batches up to ``upto`` as one; later ones stay as they are."""
        out, rows = CountedSets(self.spark, path, self.files), self.rows()
        out.append(rows.where(F.col("batch_id") <= upto).select(*ENTRY, "n"), upto)
        for r in rows.where(F.col("batch_id") > upto).select("batch_id").distinct().collect():   # one row per later batch
            out.append(rows.where(F.col("batch_id") == r["batch_id"]).select(*ENTRY, "n"), r["batch_id"])
        return out
