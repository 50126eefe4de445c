"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmart.session import materialize

# Fixed values of the query contracts: what separates words.
WS = r"[\x20\x09-\x0D]+"
NOT_WS = r"[^\x20\x09-\x0D]+"

_AZ, _az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder of the session and read back: cuts lineage, survives lost executors."""
    return materialize(df, name)


def drop_finished_shuffles(spark: SparkSession) -> None:
    """Frees the disk of shuffles whose results are written: Spark deletes them when the driver's garbage is
    collected, which a driver with room to spare puts off."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop_stored(*tables: DataFrame) -> None:
    """Deletes tables that ``stored`` wrote; whatever was derived from them has to be written by then."""
    for table in tables:
        folder = table.inputFiles()[0].rsplit("/", 1)[0]
        if "/materialized/" not in folder:
            raise ValueError(f"not a stored table: {folder}")
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def lower_az(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, _AZ, _az)


def words(c: Column) -> Column:
    """The words of a text (null: none)."""
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), WS), "")


def crc_mod(c: Column, n: int) -> Column:
    """crc32 of the number written as text, modulo n (null: of the empty text)."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


def following_id(ids: DataFrame, key: str) -> DataFrame:
    """(key, next_key) for every distinct non-null key in ascending order; the last is followed by the first.

    Range-partitioned, so no task sees all keys; only one row per partition
    (its first key) is joined across the partition borders.
    """
    keys = stored(
        ids.select(key).where(F.col(key).isNotNull()).distinct()
        .repartitionByRange(F.col(key)).withColumn("_part", F.spark_partition_id()), "keys")
    inside = keys.withColumn("_next", F.lead(key).over(Window.partitionBy("_part").orderBy(key)))
    # one row per partition: bounded by the number of partitions
    firsts = keys.groupBy("_part").agg(F.min(key).alias("_first"))
    border = firsts.select(
        "_part",
        F.coalesce(F.lead("_first").over(Window.orderBy("_part")),
                   F.min("_first").over(Window.partitionBy())).alias("_after"))
    return (inside.join(F.broadcast(border), "_part")
            .select(key, F.coalesce("_next", "_after").alias(f"next_{key}")))


def ranked(df: DataFrame, order: Iterable[Column], name: str, stored_as: str) -> DataFrame:
    """Adds ``name``: the 0-based place in a total order, without a one-task sort.

    Rows that are equal under ``order`` take neighbouring places in any order.
    """
    order = list(order)
    parts = stored(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), stored_as)
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return (parts.withColumn("_place", inside).join(F.broadcast(before), "_part")
            .withColumn(name, F.col("_before") + F.col("_place")).drop("_part", "_place", "_before"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, mod: int, held_out: int,
                    per_class: int) -> DataFrame:
    """(doc_id, text, label) of at most ``per_class`` labelled documents of each class.

    Rows of the held-out fold (crc32 of doc_id modulo ``mod``) are never read
    for training.  The choice is by hash, so it repeats; the set of chosen ids
    is bounded by 2 * per_class, which makes its broadcast safe.
    """
    known = (labels.select("doc_id", F.col(label).cast("int").alias("label"))
             .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
             .where(crc_mod(F.col("doc_id"), mod) != held_out)
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    by_hash = F.xxhash64("doc_id", F.lit(label))
    chosen = None
    for c in (0, 1):
        part = known.where(F.col("label") == c).orderBy(by_hash, "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    return (docs.select("doc_id", "text").where(F.col("text").isNotNull())
            .join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]))


def components(links: DataFrame) -> DataFrame:
    """Connected components of (a, b): one row (node, component) per node, component = smallest node.

    Label hooking with pointer jumping: every round joins labels to links, hooks
    nodes and their current roots to the smaller label, then shortens paths.
    Every round is written to the shared folder, nothing comes to the driver
    but the number of changed labels.
    """
    links = stored(links.select("a", "b").where("a <> b")
                   .union(links.select("b", "a").where("a <> b")).toDF("a", "b").distinct(), "links")
    labels = stored(links.groupBy("a").agg(F.min("b").alias("m"))
                    .select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "labels")
    while True:
        la = labels.toDF("a", "ca")
        lb = labels.toDF("b", "cb")
        seen = links.join(la, "a").join(lb, "b").where("cb < ca")
        hooks = seen.select(F.col("a").alias("node"), F.col("cb").alias("component")) \
            .union(seen.select(F.col("ca"), F.col("cb")))
        hooked = labels.union(hooks).groupBy("node").agg(F.min("component").alias("component"))
        hooked = stored(hooked, "hooked")
        roots = hooked.toDF("component", "root")
        new = stored(hooked.join(roots, "component", "left")
                     .select("node", F.least("component", "root").alias("component")), "labels")
        changed = new.join(labels.toDF("node", "old"), "node").where("component <> old").limit(1).count()
        labels = new
        if not changed:
            return labels
