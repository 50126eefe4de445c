"""Indexes that follow removals: what an index holds against what the source says.

A removed film, person or genre leaves no changed row behind, so a run over changes never sees it.  Here both
sides are reduced to rows (id, item), an item being the hash of one field group or one entry of a document.
Checksums of a fixed number of id buckets (row counts and xors, independent of order, combined map-side) are
compared first; only buckets that differ are read again, by a filter on the id that reaches the scans.  Keys
that the source no longer has get a tombstone, keys that differ are rebuilt.

NULL members of a set (a person without links) stand for no entry and are not compared.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import documents as D
from ..operators.quality import drop_orphans, valid_films
from ..operators.skew import tasks_for
from ..schemas import INDEX_GENRES, INDEX_MOVIES, INDEX_PERSONS
from ..session import materialize
from ..sources.sinks import current_view, read_if_there, remove, upsert
from .incremental import DocumentSinks

ID_BUCKETS = 4096      # checksums per side; the numbers of those that differ come to the driver


def item(kind: str, *values: Column) -> Column:
    """Hash of a field group or entry (a NULL differs from a missing value before or after it)."""
    return F.xxhash64(F.lit(kind), *[x for v in values for x in (v.cast("string"), v.isNull())])


def _entries(rows: DataFrame, key: str, kind: str, value: str, heads: DataFrame) -> DataFrame:
    """Distinct items of link rows whose key has a document."""
    return (rows.where(F.col(value).isNotNull()).select(F.col(key).alias("id"), item(kind, F.col(value)).alias("item"))
            .distinct().join(heads.select("id"), "id", "left_semi"))


def expected_rows(cat, index: str) -> DataFrame:
    """(id, item) of the documents that the source's tables ask for."""
    cat = cat.set_links()
    if index == INDEX_MOVIES:
        heads = valid_films(cat.film_work).select("id", item("head", F.col("title"), F.col("description"), F.col("rating")).alias("item"))
        entry = F.xxhash64("group", F.col("name"), F.col("ref_id").cast("string"))
        return heads.unionByName(D.film_entries(cat).select(F.col("film_id").alias("id"), entry.alias("item")))
    if index == INDEX_PERSONS:
        heads = (cat.person.where("id is not null and full_name is not null")
                 .select("id", item("head", F.col("full_name")).alias("item")))
        links = cat.person_film_work
        return reduce(DataFrame.unionByName, [heads, _entries(links, "person_id", "role", "role", heads),
                                              _entries(links, "person_id", "film", "film_work_id", heads)])
    links = cat.genre_film_work.where("film_work_id is not null")
    heads = (cat.genre.where("id is not null and name is not null")
             .join(links.select(F.col("genre_id").alias("id")).distinct(), "id", "left_semi")
             .select("id", item("head", F.col("name"), F.col("description")).alias("item")))
    return heads.unionByName(_entries(links, "genre_id", "film", "film_work_id", heads))


def held_rows(docs: DataFrame, index: str) -> DataFrame:
    """(id, item) of the documents of an index, whatever the number of their parts."""
    def members(column: str, kind: str) -> Column:
        present = F.filter(F.coalesce(F.col(column), F.array().cast(docs.schema[column].dataType)), lambda v: v.isNotNull())
        return F.transform(present, lambda v: item(kind, v))

    def entries(group: str) -> Column:
        return F.transform(group, lambda r: F.xxhash64(F.lit(group), r["name"], r["id"].cast("string")))

    if index == INDEX_MOVIES:
        head, lists = ("title", "description", "imdb_rating"), [entries(g) for g in D.DOC_GROUPS]
    elif index == INDEX_PERSONS:
        head, lists = ("name",), [members("role", "role"), members("film_ids", "film")]
    else:
        head, lists = ("name", "description"), [members("film_ids", "film")]
    top = F.when(F.col("part") == 0, F.array(item("head", *[F.col(c) for c in head]))).otherwise(F.array().cast("array<bigint>"))
    return docs.select("id", F.explode(F.concat(top, *lists)).alias("item")).distinct()


def _bucket(n: int) -> Column:
    return F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(n))


def differing_buckets(expected: DataFrame, held: DataFrame, n: int = ID_BUCKETS) -> list[int]:
    """Numbers of the id buckets whose rows differ; ``n`` at most."""
    def sums(rows: DataFrame, side: str) -> DataFrame:
        return rows.groupBy(_bucket(n).alias("bucket")).agg(F.struct(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("id", "item")), F.bit_xor(F.xxhash64("item", "id", F.lit(1)))).alias(side))

    both = sums(expected, "e").join(sums(held, "h"), "bucket", "full")
    return sorted(r["bucket"] for r in both.where(~F.col("e").eqNullSafe(F.col("h"))).select("bucket").collect())


def stale_keys(expected: DataFrame, held: DataFrame, n: int = ID_BUCKETS) -> DataFrame | None:
    """(id, gone) of the documents that differ; ``gone`` where the source has none.  None if all are equal."""
    buckets = differing_buckets(expected, held, n)
    if not buckets:
        return None
    inside = _bucket(n).isin(buckets)
    expected, held = expected.where(inside), held.where(inside)
    sides = expected.select("id", "item", F.lit(1).alias("side")).unionByName(held.select("id", "item", F.lit(-1).alias("side")))
    differ = sides.groupBy("id", "item").agg(F.sum("side").alias("side")).where("side <> 0").select("id").distinct()
    there = expected.select("id").distinct().withColumn("gone", F.lit(False))
    return differ.join(there, "id", "left").select("id", F.coalesce("gone", F.lit(True)).alias("gone"))


def _whole_links(cat):
    """The catalog with the links whose film, person and genre are there, written once: every index compares and
    rebuilds with them.  Each task cuts down as many links, however many there are."""
    cat = cat.set_links()
    films, people, genres = cat.film_work, cat.person_film_work, cat.genre_film_work
    if (tasks := tasks_for(people, genres)) > 1:
        cat = cat.with_(film_work=films.repartition(tasks, "id"), person_film_work=people.repartition(tasks, "film_work_id"),
                        genre_film_work=genres.repartition(tasks, "film_work_id"))
    whole = drop_orphans(cat.with_(person_film_work_raw=None, genre_film_work_raw=None))
    people, genres = materialize(whole.person_film_work, "whole-people"), materialize(whole.genre_film_work, "whole-genres")
    return whole.with_(film_work=films, person_film_work=people, genre_film_work=genres,
                       person_film_work_raw=people, genre_film_work_raw=genres)


BUILDERS = {INDEX_MOVIES: D.film_documents, INDEX_PERSONS: D.person_documents, INDEX_GENRES: D.genre_documents}


def reconcile(spark: SparkSession, cat, sinks: DocumentSinks, batch_id: int) -> dict[str, tuple[int, int]]:
    """Brings every index to the source's state as version ``batch_id``; (rebuilt, removed) by index.

    Links whose film, person or genre is gone count as gone too.  Repeating a batch changes nothing.
    """
    cat, done = _whole_links(cat), {}
    for index, build in BUILDERS.items():
        path = sinks.path(index)
        if read_if_there(spark, path) is None:
            continue
        stale = stale_keys(expected_rows(cat, index), held_rows(current_view(spark, path), index))
        if stale is None:
            done[index] = (0, 0)
            continue
        stale = materialize(stale, f"stale-{index}")       # before anything is written
        gone, differ = stale.where("gone").select("id"), stale.where("not gone").select("id")
        remove(gone, path, batch_id)
        upsert(build(cat, differ, buckets=sinks.buckets_of(index)), path, batch_id)
        done[index] = (differ.count(), gone.count())
    return done
