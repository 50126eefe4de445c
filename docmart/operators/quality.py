"""Row validation, constraint and integrity reports.

Validation splits a table once into valid rows and rejects (with reasons);
reports are DataFrames of violations, never driver-side loops.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import FILM_TYPES, MAX_LEN, PERSON_ROLES, RATING_RANGE

# Fields a film row must carry to become a document (reference model rules).
FILM_REQUIRED = ("id", "title", "type", "created", "modified")
PERSON_REQUIRED = ("id", "full_name")
GENRE_REQUIRED = ("id", "name")


def _reasons(checks: list[tuple[str, Column]]) -> Column:
    """array of reason strings for the failed checks (a check is True when it FAILS)."""
    return F.filter(F.array(*[F.when(bad, F.lit(reason)) for reason, bad in checks]),
                    lambda r: r.isNotNull())


def film_checks(required=FILM_REQUIRED) -> list[tuple[str, Column]]:
    return [(f"{c} is null", F.col(c).isNull()) for c in required]


def split_valid(df: DataFrame, checks: list[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows + `reasons` array) from one expression list."""
    failed = reduce(lambda a, b: a | b, [bad for _, bad in checks])
    valid = df.where(~failed)
    rejects = df.where(failed).withColumn("reasons", _reasons(checks))
    return valid, rejects


def person_checks() -> list[tuple[str, Column]]:
    return [(f"{c} is null", F.col(c).isNull()) for c in PERSON_REQUIRED]


def genre_checks() -> list[tuple[str, Column]]:
    return [(f"{c} is null", F.col(c).isNull()) for c in GENRE_REQUIRED]


def rejected_entities(cat) -> DataFrame:
    """(table_name, key, reasons): films, persons and genres that cannot become documents."""
    tables = (("film_work", cat.film_work, film_checks()), ("person", cat.person, person_checks()),
              ("genre", cat.genre, genre_checks()))
    return reduce(DataFrame.unionByName, [
        split_valid(df, checks)[1].select(F.lit(name).alias("table_name"), F.col("id").cast("string").alias("key"), "reasons")
        for name, df, checks in tables])


def valid_films(film_work: DataFrame) -> DataFrame:
    return split_valid(film_work, film_checks())[0]


def rejected_films(film_work: DataFrame) -> DataFrame:
    return split_valid(film_work, film_checks())[1]


def _violations(df: DataFrame, table: str, key: str, checks: list[tuple[str, Column]]) -> DataFrame:
    """One row per (row, failed rule): table, key, rule."""
    return (df.select(F.col(key).cast("string").alias("key"), F.explode(_reasons(checks)).alias("rule"))
              .select(F.lit(table).alias("table_name"), "key", "rule"))


def constraint_violations(cat, rating_range=RATING_RANGE, film_types=FILM_TYPES,
                          roles=PERSON_ROLES, max_len=None) -> DataFrame:
    """Range, allowed-set, length, not-null and primary-key rules (K2, K3, K5, K6)."""
    max_len = {**MAX_LEN, **(max_len or {})}
    lo, hi = rating_range
    fw = cat.film_work
    film_rules = [
        ("title not null", F.col("title").isNull()),
        (f"rating between {lo:g} and {hi:g}", ~F.coalesce(F.col("rating").between(lo, hi), F.lit(True))),
        ("type in allowed set", ~F.coalesce(F.col("type").isin(list(film_types)), F.lit(True))),
        (f"type length <= {max_len['film_work.type']}",
         F.coalesce(F.char_length("type") > max_len["film_work.type"], F.lit(False))),
        (f"certificate length <= {max_len['film_work.certificate']}",
         F.coalesce(F.char_length("certificate") > max_len["film_work.certificate"], F.lit(False))),
    ]
    person_rules = [("full_name not null", F.col("full_name").isNull())]
    genre_rules = [
        ("name not null", F.col("name").isNull()),
        (f"name length <= {max_len['genre.name']}",
         F.coalesce(F.char_length("name") > max_len["genre.name"], F.lit(False))),
    ]
    role_rules = [("role in allowed set", ~F.coalesce(F.col("role").isin(list(roles)), F.lit(True)))]
    pfw = cat.person_film_work.withColumn(
        "link_key", F.concat_ws("|", F.col("film_work_id").cast("string"), F.col("person_id").cast("string"),
                                F.coalesce(F.col("role"), F.lit(""))))
    parts = [
        _violations(fw, "film_work", "id", film_rules),
        _violations(cat.person, "person", "id", person_rules),
        _violations(cat.genre, "genre", "id", genre_rules),
        _violations(pfw, "person_film_work", "link_key", role_rules),
        duplicate_keys(fw, "film_work", "id"),
        duplicate_keys(cat.person, "person", "id"),
        duplicate_keys(cat.genre, "genre", "id"),
    ]
    return reduce(DataFrame.unionByName, parts)


def duplicate_keys(df: DataFrame, table: str, key: str) -> DataFrame:
    """Primary-key rule: keys seen more than once (partial aggregation, skew-safe)."""
    return (df.groupBy(key).count().where("count > 1")
              .select(F.lit(table).alias("table_name"), F.col(key).cast("string").alias("key"),
                      F.lit("primary key unique").alias("rule")))


def duplicate_links(cat) -> DataFrame:
    """Unique (film, genre) and (film, person, role); NULL roles never collide (K4)."""
    g = (cat.genre_film_work_raw.groupBy("film_work_id", "genre_id").count().where("count > 1")
         .select(F.lit("genre_film_work").alias("table_name"), "film_work_id",
                 F.col("genre_id").alias("other_id"), F.lit(None).cast("string").alias("role"),
                 F.col("count").alias("n")))
    p = (cat.person_film_work_raw.where(F.col("role").isNotNull())
         .groupBy("film_work_id", "person_id", "role").count().where("count > 1")
         .select(F.lit("person_film_work").alias("table_name"), "film_work_id",
                 F.col("person_id").alias("other_id"), "role", F.col("count").alias("n")))
    return g.unionByName(p)


def orphan_links(cat) -> DataFrame:
    """Link rows whose film, person or genre is missing (anti joins, K7)."""
    films = cat.film_work.select(F.col("id").alias("film_work_id"))
    people = cat.person.select(F.col("id").alias("person_id"))
    genres = cat.genre.select(F.col("id").alias("genre_id"))
    pfw, gfw = cat.person_film_work, cat.genre_film_work

    def report(df, table, missing, other):
        return df.select(F.lit(table).alias("table_name"), "film_work_id",
                         F.col(other).alias("other_id"), F.lit(missing).alias("missing"))

    return reduce(DataFrame.unionByName, [
        report(pfw.join(people, "person_id", "left_anti"), "person_film_work", "person", "person_id"),
        report(pfw.join(films, "film_work_id", "left_anti"), "person_film_work", "film_work", "person_id"),
        report(gfw.join(genres, "genre_id", "left_anti"), "genre_film_work", "genre", "genre_id"),
        report(gfw.join(films, "film_work_id", "left_anti"), "genre_film_work", "film_work", "genre_id"),
    ])


def strict_check(json_col: Column, allowed: list[str]) -> Column:
    """Unknown top-level keys of a JSON object text (sorted); [] when strict-valid."""
    return F.array_sort(F.array_except(F.json_object_keys(json_col),
                                       F.array(*[F.lit(k) for k in allowed]).cast("array<string>")))


def unknown_fields(df: DataFrame, schema) -> list[str]:
    """Field paths of ``df`` (recursively, into structs and arrays of structs)
    that the strict ``schema`` does not declare."""
    from pyspark.sql import types as T

    def walk(actual, declared, prefix):
        out = []
        if isinstance(actual, T.ArrayType) and isinstance(declared, T.ArrayType):
            return walk(actual.elementType, declared.elementType, prefix)
        if isinstance(actual, T.StructType) and isinstance(declared, T.StructType):
            known = {f.name: f.dataType for f in declared.fields}
            for f in actual.fields:
                path = f"{prefix}{f.name}"
                if f.name not in known:
                    out.append(path)
                else:
                    out += walk(f.dataType, known[f.name], path + ".")
        return out

    return walk(df.schema, schema, "")


def drop_orphans(cat):
    """Cascade rule: the catalog without link rows whose film, person or genre
    is missing (semi joins; the parents are never collected)."""
    films = cat.film_work.select(F.col("id").alias("film_work_id"))
    people = cat.person.select(F.col("id").alias("person_id"))
    genres = cat.genre.select(F.col("id").alias("genre_id"))

    def keep(links, other, parents):
        return links.join(films, "film_work_id", "left_semi").join(parents, other, "left_semi")

    pfw = keep(cat.person_film_work, "person_id", people)
    gfw = keep(cat.genre_film_work, "genre_id", genres)
    return cat.with_(person_film_work=pfw, genre_film_work=gfw,
                     person_film_work_raw=None if cat.person_film_work_raw is None
                     else keep(cat.person_film_work_raw, "person_id", people),
                     genre_film_work_raw=None if cat.genre_film_work_raw is None
                     else keep(cat.genre_film_work_raw, "genre_id", genres))
