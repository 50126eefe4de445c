"""Change detection and fan-out of changed dimension keys to film keys.

A run reads one fixed window ``lo <= modified < hi`` per table in a single
scan (parquet min/max statistics skip row groups outside it); ``hi`` is
fixed before the scan.  Changed persons / genres are carried to every film
they touch through the link tables; the three routes are unioned and
de-duplicated so each film is rebuilt once.  Nothing is collected to the
driver: changed keys stay DataFrames and restrict the rebuild by semi joins.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CHUNK_SIZE, DEFAULT_START


def ts(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def in_window(col: str, lo: str | None, hi: str | None) -> Column:
    """Inclusive low mark, exclusive high mark; NULL `modified` never matches."""
    cond = F.col(col) >= ts(lo or DEFAULT_START)
    if hi is not None:
        cond = cond & (F.col(col) < ts(hi))
    return cond


def changed_ids(table: DataFrame, lo: str | None = None, hi: str | None = None,
                ts_col: str = "modified") -> DataFrame:
    """Ids (and their mark) of rows changed in [lo, hi)."""
    return table.where(in_window(ts_col, lo, hi)).select("id", ts_col)


def changed_ids_page(table: DataFrame, lo: str | None = None, page: int = 0,
                     size: int = CHUNK_SIZE, ts_col: str = "modified") -> DataFrame:
    """One chunk of the change feed: ORDER BY modified, id  OFFSET page*size LIMIT size.

    ``id`` breaks ties so pages never skip or repeat rows.  Planned as a
    TakeOrderedAndProject (per-partition top-k, then a merge), so no full sort.
    """
    return (table.where(in_window(ts_col, lo, None)).select("id", ts_col)
                 .orderBy(ts_col, "id").offset(page * size).limit(size))


def film_ids_for(link: DataFrame, changed: DataFrame, key: str, film_work: DataFrame) -> DataFrame:
    """Films linked to changed dimension keys (link key IN changed ids), with their mark.

    A link to a film that does not exist yields nothing (join to film_work).
    """
    keys = changed.select(F.col("id").alias(key)).distinct()
    films = link.join(keys, key, "left_semi").select(F.col("film_work_id").alias("id")).distinct()
    return films.join(film_work.select("id", "modified"), "id")


def changed_film_ids(cat, film_window=(None, None), person_window=(None, None),
                     genre_window=(None, None)) -> DataFrame:
    """Union of the three change routes (genre -> film, person -> film, film), distinct."""
    cat = cat.set_links()
    routes = [
        film_ids_for(cat.genre_film_work, changed_ids(cat.genre, *genre_window), "genre_id", cat.film_work),
        film_ids_for(cat.person_film_work, changed_ids(cat.person, *person_window), "person_id", cat.film_work),
        changed_ids(cat.film_work, *film_window),
    ]
    return reduce(DataFrame.unionByName, [r.select("id") for r in routes]).distinct()


def current_mark(spark) -> datetime:
    """Now in the session's zone, truncated to whole seconds (the next high-water mark); one scalar.

    Without a zone, so the zone of the driver process cannot shift it on its way.
    """
    row = spark.range(1).select(F.date_trunc("second", F.current_timestamp()).cast("timestamp_ntz").alias("now")).first()
    return row["now"]
