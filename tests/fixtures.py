"""Hand-made catalogue fixtures (string ids, as in the reference's uuid keys)."""

from datetime import date, datetime

from pyspark.sql import types as T

from docmart.schemas import entity_schemas
from docmart.sources.tables import Catalog

T0 = datetime(2021, 7, 1, 12, 0, 0)


def film(id, title="T", rating=5.0, type="movie", created=T0, modified=T0, description=None,
         creation_date=date(2020, 1, 1)):
    return (id, title, description, creation_date, None, None, rating, type, created, modified)


def person(id, name, modified=T0):
    return (id, name, T0, modified)


def genre(id, name, modified=T0, description=None):
    return (id, name, description, T0, modified)


def plink(film_id, person_id, role, id=None):
    return (id or f"pl-{film_id}-{person_id}-{role}", person_id, film_id, role, T0)


def glink(film_id, genre_id, id=None):
    return (id or f"gl-{film_id}-{genre_id}", genre_id, film_id, T0)


def make_catalog(spark, films=(), persons=(), genres=(), plinks=(), glinks=()) -> Catalog:
    sch = entity_schemas(T.StringType())
    # nullability is a data rule checked by the jobs, not by the fixture loader
    loose = {k: T.StructType([T.StructField(f.name, f.dataType, True) for f in v.fields]) for k, v in sch.items()}
    fw = spark.createDataFrame(list(films), loose["film_work"])
    p = spark.createDataFrame(list(persons), loose["person"])
    g = spark.createDataFrame(list(genres), loose["genre"])
    pfw = spark.createDataFrame(list(plinks), loose["person_film_work"])
    gfw = spark.createDataFrame(list(glinks), loose["genre_film_work"])
    return Catalog(film_work=fw, person=p, genre=g, person_film_work=pfw, genre_film_work=gfw,
                   person_film_work_raw=pfw, genre_film_work_raw=gfw)


def rows_by_id(df, key="id"):
    return {r[key]: r.asDict(recursive=True) for r in df.collect()}
