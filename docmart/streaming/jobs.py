"""Runnable jobs (the ETL entry points).

``full``        rebuild every document and write it as one version
``incremental`` one high-water-mark run (changes since the last committed mark)
``stream``      Structured Streaming over change folders (one per table)
``reconcile``   compare every index with the tables, remove and rebuild what differs
``layout``      store the link tables by film and by person or genre under ``--layout``

With ``--layout DIR`` the incremental and stream jobs read links by the changed keys from there.

Sources: ``--tables DIR`` (the five entity tables as parquet folders),
``--jdbc-url URL`` (the same tables in a database, with ``--jdbc-property``
for its user and driver) or ``--test-sf DIR`` (the synthetic test tables
through the test mapping).
Output: ``--out DIR`` holds the three versioned indexes and the progress log;
it should be on the cluster's shared storage.
"""

from __future__ import annotations

import argparse
import json
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import documents as D
from ..schemas import INDEX_GENRES, INDEX_MOVIES, INDEX_PERSONS
from ..sources.layouts import open_link_layout, write_link_layout
from ..sources.sinks import ProgressLog, upsert
from ..sources.tables import load_catalog, load_catalog_jdbc, load_test_catalog
from ..operators.changes import current_mark
from ..session import JOB_CONF
from .incremental import CHANGE_SOURCES, DocumentSinks, run_incremental, start_document_stream
from .reconcile import reconcile


LAYOUT_TABLES = "docmart_links"


def _loader(spark: SparkSession, args):
    plain = _plain_loader(spark, args)
    if not args.layout or args.command not in ("incremental", "stream"):
        return plain

    def with_layout():
        cat = plain()
        return cat.with_(layout=open_link_layout(spark, cat, args.layout, LAYOUT_TABLES, args.layout_buckets))
    return with_layout


def _plain_loader(spark: SparkSession, args):
    if args.test_sf:
        return lambda: load_test_catalog(spark, args.test_sf)
    if args.jdbc_url:
        properties = dict(x.split("=", 1) for x in args.jdbc_property)
        return lambda: load_catalog_jdbc(spark, args.jdbc_url, properties, partitions=args.jdbc_partitions)
    return lambda: load_catalog(spark, args.tables)


def full_rebuild(spark: SparkSession, catalog_loader, sinks: DocumentSinks, progress: ProgressLog) -> int:
    """Every document, written as the next version; the marks of all three
    tables move to the run's start, so the next incremental run continues."""
    now = current_mark(spark)           # fixed before the read
    cat = catalog_loader()
    batch_id = progress.next_batch_id()
    upsert(D.genre_documents(cat, buckets=sinks.buckets_of(INDEX_GENRES)), sinks.path(INDEX_GENRES), batch_id)
    upsert(D.person_documents(cat, buckets=sinks.buckets_of(INDEX_PERSONS)), sinks.path(INDEX_PERSONS), batch_id)
    upsert(D.film_documents(cat, buckets=sinks.buckets_of(INDEX_MOVIES)), sinks.path(INDEX_MOVIES), batch_id)
    for table in CHANGE_SOURCES:
        progress.commit(table, datetime(1970, 1, 1), now, batch_id)
    return batch_id


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="docmart")
    p.add_argument("command", choices=["full", "incremental", "stream", "reconcile", "layout"])
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--tables")
    src.add_argument("--test-sf")
    src.add_argument("--jdbc-url", help="read the five tables over JDBC, by ranges of their uuid keys")
    p.add_argument("--jdbc-property", action="append", default=[], metavar="KEY=VALUE")
    p.add_argument("--jdbc-partitions", type=int, default=64)
    p.add_argument("--out", required=True)
    p.add_argument("--buckets", action="append", default=[], metavar="INDEX=N", help="rows at most per document of an index")
    p.add_argument("--slices", type=int, default=1, help="incremental: parts of a run that commit on their own")
    p.add_argument("--layout", help="folder of the link tables stored by key")
    p.add_argument("--layout-buckets", type=int, default=64, help="the same for writing and reading")
    p.add_argument("--changes", help="stream: folder with one sub-folder of (id) change files per table")
    p.add_argument("--trigger-seconds", type=int, default=60)
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--id-type", default="string", help="stream: type of the id column in change files")
    args = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"docmart-{args.command}").getOrCreate()
    for key, value in JOB_CONF.items():
        spark.conf.set(key, value)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(f"{args.out}/_work")     # shared, like the output
    buckets = {index: int(n) for index, n in (x.split("=", 1) for x in args.buckets)}
    sinks = DocumentSinks(f"{args.out}/indexes", buckets)
    progress = ProgressLog(spark, f"{args.out}/progress")
    loader = _loader(spark, args)
    sinks.ensure(spark, loader().film_work.schema["id"].dataType)
    if args.command == "layout":
        if not args.layout:
            p.error("layout needs --layout")
        write_link_layout(loader(), args.layout, LAYOUT_TABLES, args.layout_buckets)
        print(json.dumps({"layout": args.layout}))
    elif args.command == "full":
        batch = full_rebuild(spark, loader, sinks, progress)
        print(json.dumps({"batch_id": batch}))
    elif args.command == "reconcile":
        batch = progress.next_batch_id()
        done = reconcile(spark, loader(), sinks, batch)
        progress.commit("reconcile", datetime(1970, 1, 1), current_mark(spark), batch)
        print(json.dumps({"batch_id": batch, "rebuilt_removed": done}))
    elif args.command == "incremental":
        batch = run_incremental(spark, loader, sinks, progress, slices=args.slices)
        print(json.dumps({"batch_id": batch}))
    else:
        if not args.changes:
            p.error("stream needs --changes")
        parts = [spark.readStream.schema(f"id {args.id_type}").parquet(f"{args.changes}/{t}")
                 .select(F.lit(t).alias("source"), "id") for t in ("film_work", "person", "genre")]
        changes = parts[0].unionByName(parts[1]).unionByName(parts[2])
        trigger = {"availableNow": True} if args.available_now else {"processingTime": f"{args.trigger_seconds} seconds"}
        q = start_document_stream(spark, changes, loader, sinks, f"{args.out}/checkpoint", trigger)
        q.awaitTermination()
