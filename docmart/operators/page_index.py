"""Pages of an ordered table by an index of ranges, at the same cost for every page.

The index stores the ordering columns range-partitioned, one folder a range,
with a small table of the ranges: first and last key and the number of rows
before each.  Page N lies in the ranges whose counts enclose its places, so its
read opens one or two folders whatever N is, where OFFSET would sort and drop all
rows in front of it.  A feed that starts at a mark counts the rows before the mark
the same way: whole ranges by their counts, one range by reading it.

The order has to be total (it ends with a unique column), so ranges cut at any
row and a value that a third of all rows share spreads over many ranges.  The table
of ranges has one row a range, as many as the caller asked for; only it is looked up by
the driver.  An index is a snapshot: a run builds it after the mark that it reads up to.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PageIndex:
    spark: SparkSession
    path: str
    order: tuple[str, ...]
    schema: str          # of the ordering columns

    def ranges(self) -> DataFrame:
        """(range_no, first, last, n, before)."""
        return self.spark.read.parquet(f"{self.path}/ranges")

    def rows(self) -> DataFrame:
        return self.spark.read.schema(f"{self.schema}, range_no int").parquet(f"{self.path}/rows")

    def count(self) -> int:
        return self.ranges().agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def places_before(self, mark: Column) -> int:
        """The number of rows whose first ordering column is below ``mark``."""
        low = self.order[0]
        ranges = self.ranges()
        whole = ranges.where(F.col(f"last.{low}") < mark).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        cut = [r[0] for r in ranges.where((F.col(f"first.{low}") < mark) & (F.col(f"last.{low}") >= mark)).select("range_no").collect()]
        return whole + (self.rows().where(F.col("range_no").isin(cut) & (F.col(low) < mark)).count() if cut else 0)

    def slice(self, start: int, size: int) -> DataFrame:
        """(place, ordering columns...) of the places ``start`` to ``start + size - 1``, counted from 0."""
        hit = self.ranges().where((F.col("before") < start + size) & (F.col("before") + F.col("n") > start)) \
            .select("range_no", "before").collect()
        rows = self.rows().where(F.col("range_no").isin([r["range_no"] for r in hit]) if hit else F.lit(False))
        first = min((r["before"] for r in hit), default=0)
        top = rows.select(*self.order).orderBy(*self.order).limit(max(0, start + size - first))
        # at most the rows of the ranges hit, in front of the page, and the page
        place = F.row_number().over(Window.orderBy(*self.order)) - 1 + first
        return top.withColumn("place", place.cast("long")).where(F.col("place") >= start).select("place", *self.order)

    def page(self, number: int, size: int, since: Column | None = None) -> DataFrame:
        """Page ``number`` (from 0) of the rows at or after the mark ``since``."""
        before = 0 if since is None else self.places_before(since)
        return self.slice(before + number * size, size)

    def pages(self, size: int, since: Column | None = None) -> int:
        left = self.count() - (0 if since is None else self.places_before(since))
        return max(1, -(-left // size))


def write_page_index(df: DataFrame, order: list[str], path: str, ranges: int) -> PageIndex:
    """Store the index of ``df``; rows with a null in an ordering column have no place."""
    spark = df.sparkSession
    keys = df.select(*order).dropna()
    (keys.repartitionByRange(ranges, *order).withColumn("range_no", F.spark_partition_id()).sortWithinPartitions(*order)
     .write.mode("overwrite").partitionBy("range_no").parquet(f"{path}/rows"))
    key = F.struct(*order)
    index = PageIndex(spark, path, tuple(order), ", ".join(f"`{c}` {t}" for c, t in keys.dtypes))
    counted = index.rows() \
        .groupBy("range_no").agg(F.min(key).alias("first"), F.max(key).alias("last"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted.withColumn("before", before).coalesce(1).write.mode("overwrite").parquet(f"{path}/ranges")
    return index
