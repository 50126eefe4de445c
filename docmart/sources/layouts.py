"""Link tables stored by key, so a run reads the links of what changed.

Each link table is stored twice as a bucketed table: by film, and by its
person or genre.  The links of a few changed keys are then read by literal keys:
Spark opens only the files of their buckets (``SelectedBucketsCount`` in the
plan), and inside them the row groups that can hold a key, as files are sorted
by it.  No join and no shuffle is needed.  Beyond FEW keys nearly every bucket is hit, and
the keys are joined: the stored side keeps its buckets, only the keys are shuffled.

The keys that come to the driver are at most FEW + 1; the result does not depend
on which way is taken.  A key with very many links is written by ``spread`` tasks
into as many files of its bucket, which a read by literal keys scans in parallel.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

FEW = 10_000
ROWS_A_BUCKET = 1_000_000

# link table -> its key on the dimension's side
DIMENSION_KEY = {"person_film_work": "person_id", "genre_film_work": "genre_id"}
FILM_KEY = "film_work_id"


@dataclass(frozen=True)
class Keys:
    """Distinct keys: as a frame of one column, and as values if they are at most FEW."""

    frame: DataFrame
    few: tuple | None

    @classmethod
    def of(cls, keys: DataFrame | Keys) -> Keys:
        if isinstance(keys, Keys):
            return keys
        frame = keys.select(F.col(keys.columns[0]).alias("id")).where("id is not null").distinct()
        values = [r[0] for r in frame.limit(FEW + 1).collect()]
        return cls(frame, tuple(values) if len(values) <= FEW else None)

    @classmethod
    def listed(cls, values, like: DataFrame) -> Keys:
        return cls(like.sparkSession.createDataFrame([(v,) for v in values], f"id {dict(like.dtypes)['id']}"), tuple(values))


def is_among(key: str, values: tuple) -> Column:
    """``key`` is one of ``values``; numbers are written out, as a literal each takes its time."""
    if values and all(type(v) is int for v in values):
        return F.expr(f"`{key}` IN ({', '.join(map(str, values))})")
    return F.col(key).isin(list(values))


def rows_of(table: DataFrame, key: str, keys: DataFrame | Keys) -> DataFrame:
    """The rows of ``table`` whose ``key`` is among ``keys``."""
    keys = Keys.of(keys)
    if keys.few is not None:
        return table.where(is_among(key, keys.few))
    return table.join(keys.frame.withColumnRenamed("id", key), key, "left_semi").select(*table.columns)


@dataclass(frozen=True)
class LinkLayout:
    """The stored link tables of one catalog: ``prefix`` names its tables."""

    spark: SparkSession
    prefix: str

    def table(self, links: str, key: str) -> str:
        return f"{self.prefix}_{links}_{key}"

    def links(self, links: str, key: str, keys: DataFrame | Keys) -> DataFrame:
        return rows_of(self.spark.table(self.table(links, key)), key, keys)

    def films_of(self, links: str, changed: DataFrame | Keys) -> DataFrame:
        """(id) of the films linked with changed people or genres."""
        return self.links(links, DIMENSION_KEY[links], changed).select(F.col(FILM_KEY).alias("id")).distinct()

    def changed_films(self, changes: DataFrame, path: str | None = None) -> Keys:
        """The films that ``changes`` (source, id) touch, each once; many are written, as several reads follow."""
        first = changes.where("id is not null").select("source", "id").distinct().limit(FEW + 1).collect()

        def ids(source):
            if len(first) > FEW:
                return Keys.of(changes.where(F.col("source") == source).select("id"))
            return Keys.listed([r["id"] for r in first if r["source"] == source], changes)

        dimensions = [self.films_of(links, changed) for links, changed in (
            ("genre_film_work", ids("genre")), ("person_film_work", ids("person"))) if changed.few != ()]
        films = reduce(DataFrame.unionByName, dimensions, ids("film_work").frame).distinct()
        keys = Keys.of(films)
        return keys if keys.few is not None else Keys(materialize(films, "changed-films", path), None)

    def only_films(self, cat, film_ids: DataFrame | Keys):
        """The catalog cut down to some films and their links."""
        film_ids = Keys.of(film_ids)
        people = self.links("person_film_work", FILM_KEY, film_ids)
        genres = self.links("genre_film_work", FILM_KEY, film_ids)
        return cat.with_(film_work=rows_of(cat.film_work, "id", film_ids), person_film_work=people, genre_film_work=genres,
                         person_film_work_raw=people, genre_film_work_raw=genres, layout=None)

    def only_dimension(self, cat, links: str, ids: DataFrame | Keys):
        """The catalog cut down to the links of some people or genres."""
        rows = self.links(links, DIMENSION_KEY[links], ids)
        return cat.with_(**{links: rows, f"{links}_raw": rows}, layout=None)


def layout_exists(spark: SparkSession, prefix: str) -> bool:
    return all(spark.catalog.tableExists(f"{prefix}_{links}_{key}")
               for links, own in DIMENSION_KEY.items() for key in (own, FILM_KEY))


def buckets_for(cat, least: int = 16) -> int:
    """Buckets for the links of a catalog (both tables are counted): more with more rows, so that a bucket stays as large."""
    cat = cat.set_links()
    return max(least, *(-(-getattr(cat, links).count() // ROWS_A_BUCKET) for links in DIMENSION_KEY))


def write_link_layout(cat, base: str, prefix: str, buckets: int = 64, spread: int = 1) -> LinkLayout:
    """Store both link tables by both their keys under ``base`` and register them as tables.

    A bucket is written by ``spread`` tasks, so there are ``buckets * spread`` files a table; no task has two of them.
    """
    spark = cat.film_work.sparkSession
    cat = cat.set_links()
    for links, own in DIMENSION_KEY.items():
        rows = getattr(cat, links)
        for key in (own, FILM_KEY):
            other = FILM_KEY if key == own else own
            bucket, part = F.pmod(F.hash(key), F.lit(buckets)), F.pmod(F.xxhash64(other), F.lit(spread))
            (rows.where(F.col(key).isNotNull()).repartitionById(buckets * spread, (bucket * spread + part).cast("int"))
             .write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
             .option("path", f"{base}/{links}_by_{key}").saveAsTable(f"{prefix}_{links}_{key}"))
    return LinkLayout(spark, prefix)


def open_link_layout(spark: SparkSession, cat, base: str, prefix: str, buckets: int = 64) -> LinkLayout:
    """Register a layout that another session stored under ``base``."""
    for links, own in DIMENSION_KEY.items():
        columns = ", ".join(f"`{c}` {t}" for c, t in getattr(cat.set_links(), links).dtypes)
        for key in (own, FILM_KEY):
            spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}_{links}_{key} ({columns}) USING parquet "
                      f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {int(buckets)} BUCKETS "
                      f"LOCATION '{base}/{links}_by_{key}'")
    return LinkLayout(spark, prefix)
