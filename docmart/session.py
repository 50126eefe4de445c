"""Session helpers: a local session for tests/bench, and the shared work folder."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins from runtime sizes
# (size-checked broadcast, skew-join splitting, partition coalescing).
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


# Suggested settings for a large cluster (applied by the deployment, not by
# this library): AQE sizes shuffle partitions from runtime statistics, so the
# initial count is generous; skewed join partitions are split; scans are cut
# into 256 MB splits.
CLUSTER_CONF = {
    **JOB_CONF,
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "docmart") -> SparkSession:
    """Session for tests and the local bench (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for written tables and checkpoints.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir); when neither is set, a folder of the session's warehouse
    (``spark.sql.warehouse.dir``), which a deployment points at shared storage.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no context, configuration only
        sc = None
    path = sc.getCheckpointDir() if sc is not None else None
    if not path:
        path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:").rstrip("/") + "/_work"
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def subdir(spark: SparkSession, *parts: str) -> str:
    base = work_dir(spark)
    return "/".join([base, *parts]) if "://" in base else os.path.join(base, *parts)


def materialize(df, name: str, path: str | None = None):
    """Write ``df`` as parquet and read it back.

    Cuts lineage (a lost executor does not recompute the upstream plan),
    lets several consumers share one computation, and gives the planner the
    real size on disk for its broadcast decision.  The default location is a
    fresh folder under the session's shared work folder (never a machine-local
    one on a cluster); a caller with a natural key (e.g. a batch id) passes a
    fixed ``path`` so a replay overwrites instead of adding a folder.
    """
    import uuid

    spark = df.sparkSession
    path = path or subdir(spark, "materialized", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
