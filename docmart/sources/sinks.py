"""Document sinks: bulk actions, versioned idempotent upserts, progress log.

A document index is a directory of versions, one sub-folder per batch
(``batch_id=<n>``).  Writing a batch overwrites only its own folder, so a
replayed batch leaves the table unchanged (at-least-once delivery becomes
idempotent).  The current view is the latest version per key, computed with a
partial ``max_by`` aggregate (map-side combine; a hot key cannot pile up in
one task).  ``compact`` writes that view to a new folder; a job never
overwrites a path it reads.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def bulk_actions(docs: DataFrame, index: str, key: str = "id", part: str = "part") -> DataFrame:
    """Bulk index actions: _index, _id, _source (JSON, NULL fields kept).

    A document in several buckets gets ``_id`` = ``id#part`` for parts above 0 (the
    head always has the plain id); the part number itself is not a document field.
    """
    _id = F.col(key).cast("string")
    fields = [c for c in docs.columns if c != part]
    if part in docs.columns:
        _id = F.when(F.col(part) == 0, _id).otherwise(F.concat(_id, F.lit("#"), F.col(part).cast("string")))
    return docs.select(
        F.lit(index).alias("_index"),
        _id.alias("_id"),
        F.to_json(F.struct(*[F.col(c) for c in fields]), {"ignoreNullFields": "false"}).alias("_source"),
    )


def write_bulk_ndjson(actions: DataFrame, path: str) -> None:
    """Write actions in the two-line bulk NDJSON layout, partition-wise."""
    meta = F.to_json(F.struct(F.struct(F.col("_index"), F.col("_id")).alias("index")))
    actions.select(F.concat_ws("\n", meta, F.col("_source")).alias("value")).write.mode("overwrite").text(path)


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None where no path or no file exists yet; any other failure to read is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Create an empty versioned table with ``schema`` when ``path`` holds none."""
    if read_if_there(spark, path) is not None:
        return
    # an empty partitioned write leaves no file; write the schema-only file
    # into a folder that no batch owns (batches count from 0) so partition discovery finds it
    spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_id=-1")


def upsert(docs: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch of documents as version ``batch_id`` (replay-safe:
    dynamic partition overwrite replaces only that batch's folder)."""
    (docs.withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(path))


def latest_by_key(df: DataFrame, key: str, version_cols: list[str]) -> DataFrame:
    """Latest row per key by the ordering of ``version_cols`` (partial aggregate)."""
    payload = [c for c in df.columns if c != key]
    version = F.struct(*[F.col(c) for c in version_cols])
    latest = df.groupBy(key).agg(F.max_by(F.struct(*payload), version).alias("_row"))
    return latest.select(key, *[F.col(f"_row.{c}").alias(c) for c in payload])


def remove(ids: DataFrame, path: str, batch_id: int, key: str = "id") -> None:
    """Tombstones: the documents of ``ids`` are gone as of version ``batch_id`` (replay-safe like ``upsert``).

    They lie beside the table, so the documents keep their schema; a later version of a key lives again.
    """
    upsert(ids.select(key), f"{path}.removed", batch_id)


def current_view(spark: SparkSession, path: str, key: str = "id") -> DataFrame:
    """Current documents of a versioned table: every row (all parts) of the
    latest ``batch_id`` per key, so a document that shrank to fewer parts
    leaves no stale part behind; none of a key removed since."""
    versions = spark.read.parquet(path)
    newest = versions.groupBy(key).agg(F.max("batch_id").alias("batch_id"))
    removed = read_if_there(spark, f"{path}.removed")
    if removed is not None:
        last = removed.groupBy(key).agg(F.max("batch_id").alias("_removed"))
        newest = (newest.join(last, key, "left").where(F.col("_removed").isNull() | (F.col("_removed") < F.col("batch_id")))
                  .drop("_removed"))
    return versions.join(newest, [key, "batch_id"], "left_semi")


def compact(spark: SparkSession, path: str, out: str, key: str = "id") -> None:
    """Write the current view to a *new* folder as a single version."""
    if out.rstrip("/") == path.rstrip("/"):
        raise ValueError("compact must write to a new path")
    view = current_view(spark, path, key)
    newest = view.agg(F.max("batch_id")).first()[0]
    if newest is not None:
        upsert(view.drop("batch_id"), out, newest)


PROGRESS_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()), T.StructField("lo", T.TimestampNTZType()),
    T.StructField("hi", T.TimestampNTZType()), T.StructField("batch_id", T.LongType()),
    T.StructField("committed_at", T.TimestampType()),
])


class ProgressLog:
    """Append-only control table of committed windows (the high-water marks)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def commit(self, table_name: str, lo: datetime, hi: datetime, batch_id: int) -> None:
        row = [(table_name, lo, hi, int(batch_id), datetime.now(timezone.utc))]
        self.spark.createDataFrame(row, PROGRESS_SCHEMA).write.mode("append").parquet(self.path)

    def last_mark(self, table_name: str, default: datetime | None = None) -> datetime | None:
        """Highest committed ``hi`` for a table (one scalar to the driver)."""
        df = read_if_there(self.spark, self.path)
        if df is None:
            return default
        row = df.where(F.col("table_name") == table_name).agg(F.max("hi").alias("hi")).first()
        return row["hi"] if row and row["hi"] is not None else default

    def next_batch_id(self) -> int:
        df = read_if_there(self.spark, self.path)
        if df is None:
            return 1
        row = df.agg(F.max("batch_id").alias("b")).first()
        return (row["b"] or 0) + 1
