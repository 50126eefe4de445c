"""Incremental document maintenance, batch and Structured Streaming.

One micro-batch = the rows of film_work / person / genre that changed.  Inside
``foreachBatch`` the batch's keys are fanned out to film keys through the link
tables, and the three document kinds are rebuilt and written as version
``batch_id`` (idempotent on replay).  The dimension and link tables are
re-read for every batch (``catalog_loader`` is called inside the batch), so a
long-running query never serves names from a stale file listing.

Progress lives in the streaming checkpoint (file-source offsets); the batch
runner keeps an equivalent control table.  Either way the write happens
before the commit, so a lost executor or driver only causes a replay.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import documents as D
from ..operators.changes import changed_ids, current_mark, film_ids_for, in_window
from ..schemas import INDEX_GENRES, INDEX_MOVIES, INDEX_PERSONS
from ..session import materialize
from ..sources.sinks import ProgressLog, read_if_there, upsert

CHANGE_SOURCES = ("genre", "person", "film_work")


@dataclass(frozen=True)
class DocumentSinks:
    base: str
    # rows at most per document, by index (see operators.skew); one where none is given
    buckets: Mapping[str, int] = field(default_factory=dict)

    def path(self, index: str) -> str:
        return f"{self.base}/{index}"

    def buckets_of(self, index: str) -> int:
        return self.buckets.get(index, 1)

    def ensure(self, spark: SparkSession, id_type=None) -> None:
        """Create each index with its declared schema when missing."""
        from pyspark.sql import types as T

        from ..schemas import film_document_schema, genre_document_schema, person_document_schema
        from ..sources.sinks import ensure_table
        t = id_type or T.StringType()
        for index, schema in ((INDEX_MOVIES, film_document_schema(t)), (INDEX_PERSONS, person_document_schema(t)),
                              (INDEX_GENRES, genre_document_schema(t))):
            ensure_table(spark, self.path(index), schema)


def process_changes(cat, changes: DataFrame, sinks: DocumentSinks, batch_id: int) -> None:
    """Rebuild and write every document touched by ``changes`` (source, id).

    genre -> genre documents + their films; person -> person documents + their
    films; film_work -> the films.  Films reached by several routes are
    rebuilt once (union + distinct).  With a link layout the cost follows the
    change: links are read by the changed keys only.
    """
    if cat.layout is not None:
        return _process_by_layout(cat, changes, sinks, batch_id)
    cat = cat.set_links()
    genre_ids = changes.where(F.col("source") == "genre").select("id")
    person_ids = changes.where(F.col("source") == "person").select("id")
    film_ids = (
        film_ids_for(cat.genre_film_work, genre_ids, "genre_id", cat.film_work).select("id")
        .unionByName(film_ids_for(cat.person_film_work, person_ids, "person_id", cat.film_work).select("id"))
        .unionByName(changes.where(F.col("source") == "film_work").select("id"))
        .distinct()
    )
    # three consumers (film scan and both link scans): compute the keys once
    film_ids = materialize(film_ids, "changed-films", f"{sinks.base}/_work/changed_films/batch_id={batch_id}")
    upsert(D.genre_documents(cat, genre_ids, sinks.buckets_of(INDEX_GENRES)), sinks.path(INDEX_GENRES), batch_id)
    upsert(D.person_documents(cat, person_ids, sinks.buckets_of(INDEX_PERSONS)), sinks.path(INDEX_PERSONS), batch_id)
    upsert(D.film_documents(cat, film_ids, sinks.buckets_of(INDEX_MOVIES)), sinks.path(INDEX_MOVIES), batch_id)


def _process_by_layout(cat, changes: DataFrame, sinks: DocumentSinks, batch_id: int) -> None:
    layout = cat.layout
    genre_ids, person_ids = (changes.where(F.col("source") == s).select("id").distinct() for s in ("genre", "person"))
    film_ids = layout.changed_films(changes, f"{sinks.base}/_work/changed_films/batch_id={batch_id}")
    upsert(D.genre_documents(layout.only_dimension(cat, "genre_film_work", genre_ids), genre_ids, sinks.buckets_of(INDEX_GENRES)),
           sinks.path(INDEX_GENRES), batch_id)
    upsert(D.person_documents(layout.only_dimension(cat, "person_film_work", person_ids), person_ids, sinks.buckets_of(INDEX_PERSONS)),
           sinks.path(INDEX_PERSONS), batch_id)
    upsert(D.film_documents(layout.only_films(cat, film_ids), buckets=sinks.buckets_of(INDEX_MOVIES)), sinks.path(INDEX_MOVIES), batch_id)


def change_rows(cat, windows: dict[str, tuple]) -> DataFrame:
    """(source, id, modified) rows of every table changed in its [lo, hi) window."""
    parts = [changed_ids(getattr(cat, t), lo, hi).select(F.lit(t).alias("source"), "id", F.col("modified").cast("timestamp_ntz"))
             for t, (lo, hi) in windows.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _seen_path(sinks: DocumentSinks, batch_id: int) -> str:
    return f"{sinks.base}/_work/seen/batch_id={batch_id}"


def unseen(spark: SparkSession, rows: DataFrame, sinks: DocumentSinks, batch_id: int) -> DataFrame:
    """``rows`` (source, id, modified) without those that the committed batch ``batch_id`` remembers."""
    seen = read_if_there(spark, _seen_path(sinks, batch_id))
    if seen is None:
        return rows
    return rows.join(seen, ["source", "id", "modified"], "left_anti")


def remember(spark: SparkSession, rows: DataFrame, sinks: DocumentSinks, last: int, batch_id: int, since: str) -> None:
    """Stores, for the batch after ``batch_id``, the rows from ``since`` on that this one and ``last`` have done.

    The next windows begin at that mark, so nothing older can come again and the table holds one lookback only.
    """
    seen = read_if_there(spark, _seen_path(sinks, last))
    rows = rows if seen is None else rows.unionByName(seen)
    materialize(rows.where(in_window("modified", since, None)).distinct(), "seen", _seen_path(sinks, batch_id))


def slice_marks(cat, windows: dict[str, tuple], slices: int) -> list[datetime]:
    """Where to cut the windows so that each slice holds about as many changes: quantiles of ``modified``
    over all tables from one sketch."""
    parts = [getattr(cat, t).where(in_window("modified", lo, hi)).select(F.col("modified").cast("timestamp_ntz"))
             for t, (lo, hi) in windows.items()]
    shares = ", ".join(str(i / slices) for i in range(1, slices))
    marks = reduce(DataFrame.unionByName, parts).agg(F.expr(f"approx_percentile(modified, array({shares}))")).first()[0]
    return sorted(set(marks or []))


def run_incremental(spark: SparkSession, catalog_loader: Callable[[], object], sinks: DocumentSinks,
                    progress: ProgressLog, now: datetime | None = None,
                    lookback: timedelta = timedelta(seconds=1),
                    default_start: datetime | None = None, slices: int = 1) -> int:
    """One batch run: read each table's window [mark - lookback, now), write, commit.

    ``now`` (the new high mark) is fixed before the scan, so a row committed
    during the run with an older ``modified`` is read by the next run.  What the
    lookback reads again is left out if the last batch has done it with the same
    ``modified`` (``unseen``), so a row rebuilds its documents once.  With
    ``slices`` the windows are cut at quantiles of ``modified``; every slice is
    written and committed on its own, in time order, so a run that dies goes on
    at the slice that it did not finish.
    """
    now = now or current_mark(spark)
    cat = catalog_loader()
    start = default_start or datetime(2021, 6, 13)
    low = {}
    for t in CHANGE_SOURCES:
        mark = progress.last_mark(t)
        low[t] = (mark - lookback) if mark is not None else start

    def text(at: datetime) -> str:
        return at.strftime("%Y-%m-%d %H:%M:%S.%f")

    cuts = slice_marks(cat, {t: (text(lo), text(now)) for t, lo in low.items()}, slices) if slices > 1 else []
    batch_id = progress.next_batch_id() - 1
    for end in [*[c for c in cuts if c < now], now]:
        last, batch_id = batch_id, progress.next_batch_id()
        windows = {t: (text(lo), text(end)) for t, lo in low.items() if lo < end}
        if windows:
            rows = materialize(unseen(spark, change_rows(cat, windows), sinks, last), "changes",
                               f"{sinks.base}/_work/changes/batch_id={batch_id}")
            process_changes(cat, rows.select("source", "id"), sinks, batch_id)
            remember(spark, rows, sinks, last, batch_id, text(end - lookback))
        for t in windows or CHANGE_SOURCES:
            progress.commit(t, low[t], end, batch_id)
        low = {t: max(lo, end) for t, lo in low.items()}
    return batch_id


def start_document_stream(spark: SparkSession, change_stream: DataFrame,
                          catalog_loader: Callable[[], object], sinks: DocumentSinks,
                          checkpoint: str, trigger: dict | None = None):
    """Structured Streaming job: ``change_stream`` yields (source, id) rows
    (e.g. file sources over the three tables' change folders); each
    micro-batch rebuilds the touched documents.  Default trigger: every 60 s.
    """
    def each_batch(batch: DataFrame, batch_id: int) -> None:
        # the batch feeds three writes: keep it once (memory and disk);
        # a lost block is recomputed from the file source, not lost
        batch = batch.persist()
        try:
            process_changes(catalog_loader(), batch, sinks, batch_id)
        finally:
            batch.unpersist()

    writer = (change_stream.writeStream.foreachBatch(each_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(**(trigger or {"processingTime": "60 seconds"}))
    return writer.start()
