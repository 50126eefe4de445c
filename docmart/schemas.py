"""Declared schemas and fixed values: the single source for every job."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values that must equal the reference's (do not change) ----------
# Person roles as stored; the "writers" group is the role value "producer".
ROLE_ACTOR = "actor"
ROLE_WRITER = "producer"
ROLE_DIRECTOR = "director"
# document field group -> stored role value, in document order
ROLE_GROUPS = {"actors": ROLE_ACTOR, "writers": ROLE_WRITER, "directors": ROLE_DIRECTOR}
FILM_TYPES = ("movie", "TV series")
PERSON_ROLES = (ROLE_ACTOR, ROLE_WRITER, ROLE_DIRECTOR)
DEFAULT_START = "2021-06-13 00:00:00"   # first-run high-water mark
CHUNK_SIZE = 100                        # ids per change chunk
PAGE_SIZE = 50                          # API page size
RATING_RANGE = (0.0, 100.0)
MAX_LEN = {"genre.name": 255, "film_work.certificate": 512, "film_work.type": 32}
INDEX_MOVIES, INDEX_PERSONS, INDEX_GENRES = "movies", "persons", "genres"
# -----------------------------------------------------------------------------

S = T.StringType()
TS = T.TimestampType()


def _f(name, typ, nullable=True):
    return T.StructField(name, typ, nullable)


def entity_schemas(id_type: T.DataType = S) -> dict[str, T.StructType]:
    """Input table schemas; ``id_type`` is STRING for uuids, BIGINT on test data."""
    return {
        "film_work": T.StructType([
            _f("id", id_type, False), _f("title", S, False), _f("description", S),
            _f("creation_date", T.DateType()), _f("certificate", S), _f("file_path", S),
            _f("rating", T.DoubleType()), _f("type", S), _f("created", TS), _f("modified", TS)]),
        "person": T.StructType([
            _f("id", id_type, False), _f("full_name", S, False), _f("created", TS), _f("modified", TS)]),
        "genre": T.StructType([
            _f("id", id_type, False), _f("name", S, False), _f("description", S),
            _f("created", TS), _f("modified", TS)]),
        "person_film_work": T.StructType([
            _f("id", id_type), _f("person_id", id_type, False), _f("film_work_id", id_type, False),
            _f("role", S), _f("created", TS)]),
        "genre_film_work": T.StructType([
            _f("id", id_type), _f("genre_id", id_type, False), _f("film_work_id", id_type, False),
            _f("created", TS)]),
    }


def _ref(id_type):
    return T.StructType([_f("id", id_type), _f("name", S)])


def film_document_schema(id_type: T.DataType = S) -> T.StructType:
    arr_ref, arr_s = T.ArrayType(_ref(id_type)), T.ArrayType(S)
    fields = [_f("id", id_type, False), _f("part", T.IntegerType(), False), _f("title", S),
              _f("description", S), _f("imdb_rating", T.DoubleType())]
    for group in ("actors", "writers", "directors", "genres"):
        fields += [_f(group, arr_ref), _f(f"{group}_names", arr_s)]
    return T.StructType(fields)


def person_document_schema(id_type: T.DataType = S) -> T.StructType:
    return T.StructType([_f("id", id_type, False), _f("part", T.IntegerType(), False), _f("name", S),
                         _f("role", T.ArrayType(S)), _f("film_ids", T.ArrayType(id_type))])


def genre_document_schema(id_type: T.DataType = S) -> T.StructType:
    return T.StructType([_f("id", id_type, False), _f("part", T.IntegerType(), False), _f("name", S),
                         _f("description", S), _f("film_ids", T.ArrayType(id_type))])
