"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each plan reads the test tables through the mapping in
``sources.tables.load_test_catalog`` and returns flat, comparable columns
(arrays rendered as sorted text) so the DuckDB oracle in ``oracle.py`` can
check it value by value.  The library functions themselves return the
nested documents.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sets import join_refs, join_values
from ..operators import catalog as K
from ..operators import changes as C
from ..operators import counted_sets as CS
from ..operators import documents as D
from ..operators import element_index as EI
from ..operators import page_index as PI
from ..operators import quality as Q
from ..operators import stemming as ST
from ..operators import strict_json as SJ
from ..operators import text_index as TX
from ..operators import trigram_index as TG
from ..session import materialize, subdir
from ..sources import layouts as LY
from ..sources import sinks as SK
from ..sources.tables import load_test_catalog
from ..streaming.incremental import DocumentSinks
from ..streaming.reconcile import reconcile
from . import params as P

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def run_query(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    return QUERIES[name](spark, sf_dir)


def flat_film_documents(docs: DataFrame) -> DataFrame:
    cols = [F.col("id"), "part", "title", "description", "imdb_rating"]
    for g in ("actors", "writers", "directors", "genres"):
        cols += [join_refs(g).alias(g), F.array_join(f"{g}_names", ",").alias(f"{g}_names")]
    return docs.select(*cols)


@query
def film_documents(spark, sf_dir):
    return flat_film_documents(D.film_documents(load_test_catalog(spark, sf_dir)))


@query
def person_documents(spark, sf_dir):
    docs = D.person_documents(load_test_catalog(spark, sf_dir))
    return docs.select("id", "part", "name", join_values("role").alias("role"),
                       join_values("film_ids").alias("film_ids"))


@query
def genre_documents(spark, sf_dir):
    docs = D.genre_documents(load_test_catalog(spark, sf_dir))
    return docs.select("id", "part", "name", "description", join_values("film_ids").alias("film_ids"))


@query
def film_wide_rows(spark, sf_dir):
    rows = D.film_link_rows(load_test_catalog(spark, sf_dir))
    return rows.select("fw_id", "title", "description", "rating", "type",
                       F.col("created").cast("string").alias("created"),
                       F.col("modified").cast("string").alias("modified"),
                       "kind", "role", "person_id", "full_name", "genre_id", "name")


@query
def document_array_metrics(spark, sf_dir):
    """The largest array of each document kind, as rows."""
    from ..operators.skew import array_sizes

    cat = load_test_catalog(spark, sf_dir)
    return (array_sizes(D.film_documents(cat), ["actors", "writers", "directors", "genres"], "film")
            .unionByName(array_sizes(D.person_documents(cat), ["film_ids"], "person"))
            .unionByName(array_sizes(D.genre_documents(cat), ["film_ids"], "genre")))


@query
def film_entries(spark, sf_dir):
    """The stored form without collected arrays: one row per film, group and name."""
    return D.film_entries(load_test_catalog(spark, sf_dir))


@query
def person_documents_bucketed(spark, sf_dir):
    """Person documents in a fixed number of buckets, the same for every person."""
    docs = D.person_documents(load_test_catalog(spark, sf_dir), buckets=P.BUCKETS)
    return docs.select("id", "part", "name", join_values("role").alias("role"),
                       join_values("film_ids").alias("film_ids"))


# ---- change detection -------------------------------------------------------


def _windows():
    return dict(film_window=(P.FILM_LO, P.FILM_HI), person_window=(P.PERSON_LO, P.PERSON_HI),
                genre_window=(P.GENRE_LO, P.GENRE_HI))


def _ts_str(df: DataFrame, col: str = "modified") -> DataFrame:
    return df.withColumn(col, F.col(col).cast("string"))


@query
def changed_ids(spark, sf_dir):
    cat = load_test_catalog(spark, sf_dir)
    return _ts_str(C.changed_ids(cat.film_work, P.FILM_LO, P.FILM_HI))


@query
def changed_ids_page(spark, sf_dir):
    cat = load_test_catalog(spark, sf_dir)
    return _ts_str(C.changed_ids_page(cat.film_work, P.FILM_LO, page=2))


@query
def film_ids_for_genre(spark, sf_dir):
    cat = load_test_catalog(spark, sf_dir)
    changed = C.changed_ids(cat.genre, P.GENRE_LO, P.GENRE_HI)
    return _ts_str(C.film_ids_for(cat.genre_film_work, changed, "genre_id", cat.film_work))


@query
def film_ids_for_person(spark, sf_dir):
    cat = load_test_catalog(spark, sf_dir)
    changed = C.changed_ids(cat.person, P.PERSON_LO, P.PERSON_HI)
    return _ts_str(C.film_ids_for(cat.person_film_work, changed, "person_id", cat.film_work))


@query
def changed_film_ids(spark, sf_dir):
    return C.changed_film_ids(load_test_catalog(spark, sf_dir), **_windows())


@query
def incremental_film_documents(spark, sf_dir):
    cat = load_test_catalog(spark, sf_dir)
    changed = materialize(C.changed_film_ids(cat, **_windows()), "changed-film-ids")
    return flat_film_documents(D.film_documents(cat, changed))


@query
def incremental_person_documents(spark, sf_dir):
    """Side output of a run: documents of the people changed in the window."""
    cat = load_test_catalog(spark, sf_dir)
    docs = D.person_documents(cat, C.changed_ids(cat.person, P.PERSON_LO, P.PERSON_HI).select("id"))
    return docs.select("id", "part", "name", join_values("role").alias("role"),
                       join_values("film_ids").alias("film_ids"))


@query
def incremental_genre_documents(spark, sf_dir):
    """Side output of a run: documents of the genres changed in the window."""
    cat = load_test_catalog(spark, sf_dir)
    docs = D.genre_documents(cat, C.changed_ids(cat.genre, P.GENRE_LO, P.GENRE_HI).select("id"))
    return docs.select("id", "part", "name", "description", join_values("film_ids").alias("film_ids"))


# ---- catalogue ---------------------------------------------------------------


def flat_api(rows: DataFrame) -> DataFrame:
    return rows.select("id", "title", "description",
                       F.col("creation_date").cast("string").alias("creation_date"),
                       "rating", "type", *[join_values(c).alias(c) for c in ("genres", "actors", "directors", "writers")])


@query
def catalog_list(spark, sf_dir):
    return flat_api(K.catalog_page(load_test_catalog(spark, sf_dir), P.PAGE))


@query
def catalog_response(spark, sf_dir):
    """The list response of one page as a single JSON body."""
    return K.catalog_response(load_test_catalog(spark, sf_dir), P.PAGE)


@query
def catalog_last_page(spark, sf_dir):
    return flat_api(K.catalog_page(load_test_catalog(spark, sf_dir), "last"))


@query
def catalog_page_meta(spark, sf_dir):
    return K.catalog_page_meta(load_test_catalog(spark, sf_dir), P.PAGE)


@query
def catalog_detail(spark, sf_dir):
    return flat_api(K.catalog_detail(load_test_catalog(spark, sf_dir)).drop("body"))


def _admin(df: DataFrame) -> DataFrame:
    return df.withColumn("creation_date", F.col("creation_date").cast("string"))


@query
def search_films(spark, sf_dir):
    return _admin(K.search_films(load_test_catalog(spark, sf_dir), P.FILM_SEARCH))


@query
def search_people(spark, sf_dir):
    return K.search_people(load_test_catalog(spark, sf_dir), P.PERSON_SEARCH)


@query
def search_genres(spark, sf_dir):
    return K.search_genres(load_test_catalog(spark, sf_dir), P.GENRE_SEARCH)


@query
def filter_films_by_type(spark, sf_dir):
    return _admin(K.filter_films_by_type(load_test_catalog(spark, sf_dir), P.FILTER_TYPE))


@query
def filter_films_by_genre(spark, sf_dir):
    cat = load_test_catalog(spark, sf_dir)
    return _admin(K.filter_films_by_genre(cat, K.genre_ids_named(cat, P.FILTER_GENRE_NAME)))


@query
def film_cast_ordered(spark, sf_dir):
    return K.film_cast_ordered(load_test_catalog(spark, sf_dir))


@query
def films_by_title(spark, sf_dir):
    return K.films_by_title(load_test_catalog(spark, sf_dir))


# ---- data quality --------------------------------------------------------------


def _film_rows(df: DataFrame) -> DataFrame:
    return df.select("id", "title", "description", F.col("creation_date").cast("string").alias("creation_date"),
                     "rating", "type", F.col("created").cast("string").alias("created"),
                     F.col("modified").cast("string").alias("modified"),
                     *([F.array_join("reasons", ",").alias("reasons")] if "reasons" in df.columns else []))


@query
def valid_films(spark, sf_dir):
    return _film_rows(Q.valid_films(load_test_catalog(spark, sf_dir).film_work))


@query
def rejected_films(spark, sf_dir):
    return _film_rows(Q.rejected_films(load_test_catalog(spark, sf_dir).film_work))


@query
def constraint_violations(spark, sf_dir):
    return Q.constraint_violations(load_test_catalog(spark, sf_dir), rating_range=P.RATING_RANGE,
                                   film_types=P.FILM_TYPES, max_len={"genre.name": P.GENRE_NAME_MAX})


@query
def duplicate_links(spark, sf_dir):
    return Q.duplicate_links(load_test_catalog(spark, sf_dir))


@query
def orphan_links(spark, sf_dir):
    return Q.orphan_links(load_test_catalog(spark, sf_dir))


def _events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet")


@query
def strict_check(spark, sf_dir):
    unknown = Q.strict_check(F.col("props"), list(P.EVENT_KEYS))
    return _events(spark, sf_dir).select(
        "event_id", F.array_join(unknown, ",").alias("unknown_keys"), (F.size(unknown) == 0).alias("valid"))


@query
def strict_violations(spark, sf_dir):
    return strict_check(spark, sf_dir).where(~F.col("valid"))


# ---- sinks and streaming ---------------------------------------------------------


@query
def bulk_actions(spark, sf_dir):
    docs = D.person_documents(load_test_catalog(spark, sf_dir))
    return SK.bulk_actions(docs, "persons")


@query
def latest_documents(spark, sf_dir):
    """Current version per key of a change log (latest event per user)."""
    latest = SK.latest_by_key(_events(spark, sf_dir), "user_id", ["ts", "event_id"])
    return latest.withColumn("ts", F.col("ts").cast("string"))


@query
def stream_documents(spark, sf_dir):
    """File-source streams over the three entity tables -> foreachBatch document
    rebuild -> versioned sink; returns the sink's current film documents."""
    from ..sources.tables import TEST_MAPPING
    from ..streaming.incremental import DocumentSinks, start_document_stream

    run = subdir(spark, "stream_documents", uuid.uuid4().hex)
    marks = {"film_work": P.FILM_LO, "person": P.PERSON_LO, "genre": P.GENRE_LO}

    def stream_of(table: str) -> DataFrame:
        source, mapping = TEST_MAPPING[table]
        raw = (spark.readStream.schema(spark.read.parquet(f"{sf_dir}/{table}.parquet").schema)
               .option("pathGlobFilter", f"{table}.parquet").option("maxFilesPerTrigger", 1)
               .parquet(sf_dir))
        return (mapping(raw).where(C.in_window("modified", marks[source], None))
                .select(F.lit(source).alias("source"), "id"))

    changes = stream_of("orders").unionByName(stream_of("supplier")).unionByName(stream_of("part"))
    sinks = DocumentSinks(f"{run}/indexes")
    q = start_document_stream(spark, changes, lambda: load_test_catalog(spark, sf_dir), sinks,
                              checkpoint=f"{run}/checkpoint", trigger={"availableNow": True})
    q.awaitTermination()
    return flat_film_documents(SK.current_view(spark, sinks.path("movies")).drop("batch_id"))


# ---- text ------------------------------------------------------------------------


def _documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


@query
def analysed_tokens(spark, sf_dir):
    return TX.analysed_tokens(_documents(spark, sf_dir))


@query
def term_postings(spark, sf_dir):
    return TX.term_postings(TX.analysed_tokens(_documents(spark, sf_dir)))


@query
def film_field_tokens(spark, sf_dir):
    """Analysis of the film index's own fields (title, description, name lists)."""
    return TX.film_field_tokens(D.film_documents(load_test_catalog(spark, sf_dir)))


@query
def person_field_tokens(spark, sf_dir):
    """Analysis of the persons index's text field."""
    docs = D.person_documents(load_test_catalog(spark, sf_dir))
    return TX.film_field_tokens(docs, TX.ANALYSED_PERSON_FIELDS)


@query
def genre_field_tokens(spark, sf_dir):
    """Analysis of the genres index's text fields."""
    docs = D.genre_documents(load_test_catalog(spark, sf_dir))
    return TX.film_field_tokens(docs, TX.ANALYSED_GENRE_FIELDS)


@query
def nested_match(spark, sf_dir):
    """Nested match: films with an actor who also directs them (same id and name
    on one element of each array)."""
    cat = load_test_catalog(spark, sf_dir)
    return TX.same_person_in(D.film_entries(cat), "actors", "directors")


@query
def films_of_person(spark, sf_dir):
    return TX.films_of_person(D.film_entries(load_test_catalog(spark, sf_dir)))


@query
def catalog_detail_by_id(spark, sf_dir):
    """The API detail body of one film, its id pushed to the scans."""
    return K.catalog_detail(load_test_catalog(spark, sf_dir), P.DETAIL_ID).select("id", "body")


@query
def catalog_detail_json(spark, sf_dir):
    """The API detail body of every film as JSON text (NULLs kept)."""
    return K.catalog_detail(load_test_catalog(spark, sf_dir)).select("id", "body")


@query
def bulk_actions_movies(spark, sf_dir):
    """Bulk index actions of the movies index: nested documents as JSON bodies."""
    return SK.bulk_actions(D.film_documents(load_test_catalog(spark, sf_dir)), "movies")


# ---- links stored by key ---------------------------------------------------------


def _with_layout(spark, sf_dir):
    """The test catalog with its links stored by key: written on the first use in a session, read afterwards."""
    cat = load_test_catalog(spark, sf_dir)
    name = hashlib.md5(sf_dir.encode()).hexdigest()
    prefix, base = f"links_{name}", subdir(spark, "link_layouts", f"{name}-{spark.sparkContext.applicationId}")
    layout = LY.LinkLayout(spark, prefix) if LY.layout_exists(spark, prefix) else LY.write_link_layout(cat, base, prefix, LY.buckets_for(cat))
    return cat.with_(layout=layout)


def _batch_changes(cat) -> DataFrame:
    films = C.changed_ids(cat.film_work, P.BATCH_DAY, P.BATCH_NEXT_DAY).select(F.lit("film_work").alias("source"), "id")
    people = cat.person.where(F.col("id").isin(*P.BATCH_PERSONS)).select(F.lit("person").alias("source"), "id")
    genres = cat.genre.where(F.col("id").isin(*P.BATCH_GENRES)).select(F.lit("genre").alias("source"), "id")
    return films.unionByName(people).unionByName(genres)


@query
def batch_film_documents(spark, sf_dir):
    """Film documents of one micro-batch of changes, links read by the changed keys."""
    cat = _with_layout(spark, sf_dir)
    films = cat.layout.changed_films(_batch_changes(cat))
    return flat_film_documents(D.film_documents(cat.layout.only_films(cat, films)))


@query
def batch_person_documents(spark, sf_dir):
    cat = _with_layout(spark, sf_dir)
    ids = cat.person.where(F.col("id").isin(*P.BATCH_PERSONS)).select("id")
    docs = D.person_documents(cat.layout.only_dimension(cat, "person_film_work", ids), ids)
    return docs.select("id", "part", "name", join_values("role").alias("role"), join_values("film_ids").alias("film_ids"))


@query
def batch_genre_documents(spark, sf_dir):
    cat = _with_layout(spark, sf_dir)
    ids = cat.genre.where(F.col("id").isin(*P.BATCH_GENRES)).select("id")
    docs = D.genre_documents(cat.layout.only_dimension(cat, "genre_film_work", ids), ids)
    return docs.select("id", "part", "name", "description", join_values("film_ids").alias("film_ids"))


# ---- element-level postings --------------------------------------------------------


def _element_postings(spark, sf_dir):
    return EI.element_postings(D.film_entries(load_test_catalog(spark, sf_dir)))


@query
def element_postings(spark, sf_dir):
    """(term, film, group, element, pos) over the analysed names of every film's lists."""
    return _element_postings(spark, sf_dir)


@query
def nested_name_and_id(spark, sf_dir):
    """Films with one element whose name holds the text and that has the id."""
    return EI.nested_films(_element_postings(spark, sf_dir), P.NESTED_GROUP, P.NESTED_TEXT, P.NESTED_ID)


@query
def nested_name_terms(spark, sf_dir):
    """Films with one element whose name holds every term of the text."""
    return EI.nested_films(_element_postings(spark, sf_dir), P.NAMES_GROUP, P.NAMES_TEXT)


@query
def flat_name_terms(spark, sf_dir):
    """Films whose names together hold every term; ``nested`` tells whether one element does."""
    postings = materialize(_element_postings(spark, sf_dir), "element-postings")
    nested = EI.nested_films(postings, P.NAMES_GROUP, P.NAMES_TEXT).select("film_id").distinct().withColumn("nested", F.lit(True))
    return (EI.flat_films(postings, P.NAMES_GROUP, P.NAMES_TEXT).join(nested, "film_id", "left")
            .fillna(False, ["nested"]))


# ---- strictness inside bodies --------------------------------------------------------

_REF = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
BODY_SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("title", T.StringType()),
                            T.StructField("maker", _REF), T.StructField("lines", T.ArrayType(_REF))])


def _bodies(spark, sf_dir):
    """A JSON body per film; by the film's id a key too many at the top, in its object or in a list, or a cut text."""
    kind = F.col("o_orderkey") % 5
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_orderkey").agg(F.collect_list(F.struct(
        F.col("l_partkey").alias("id"), F.col("l_returnflag").alias("name"),
        F.when((F.col("l_orderkey") % 5 == 3) & (F.col("l_linenumber") == 2), F.col("l_quantity")).alias("quantity"))).alias("lines"))
    body = F.to_json(F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("title"),
        F.when(kind == 1, F.col("o_orderstatus")).alias("status"),
        F.struct(F.col("o_custkey").alias("id"), F.when(kind == 2, F.lit("now")).alias("since")).alias("maker"), "lines"))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    cut = F.when(kind == 4, F.substring("body", F.lit(1), F.char_length("body") - 1)).otherwise(F.col("body"))
    return orders.withColumn("body", body).select(F.col("o_orderkey").alias("id"), cut.alias("body"))


@query
def strict_bodies(spark, sf_dir):
    """Every body with the undeclared keys that it holds at any depth."""
    bodies = materialize(_bodies(spark, sf_dir), "bodies")
    unknown = SJ.unknown_keys(bodies, "id", "body", BODY_SCHEMA).groupBy("id").agg(
        F.array_join(F.array_sort(F.collect_set("path")), ",").alias("unknown"))
    return bodies.select("id").join(unknown, "id", "left").withColumn("valid", F.col("unknown").isNull())


# ---- stems -----------------------------------------------------------------------------

STEMMERS = {"english_stems": ST.english_stem, "russian_stems": ST.russian_stem}


@query
def term_stems(spark, sf_dir):
    """(term, stem) of the English stemmer over the vocabulary of the documents."""
    words = _documents(spark, sf_dir).select(F.explode(F.regexp_extract_all(
        F.lower("text"), F.lit(TX.TOKEN_PATTERN), 0)).alias("term")).distinct()
    return words.withColumn("stem", ST.english_stem(F.col("term")))


@query
def stemmed_postings(spark, sf_dir):
    """Postings of the whole analyser chain, both stemmers included."""
    return TX.term_postings(TX.analysed_tokens(_documents(spark, sf_dir), **STEMMERS))


# ---- documents in fixed buckets ----------------------------------------------------------


@query
def film_documents_bucketed(spark, sf_dir):
    return flat_film_documents(D.film_documents(load_test_catalog(spark, sf_dir), buckets=P.BUCKETS))


@query
def genre_documents_bucketed(spark, sf_dir):
    docs = D.genre_documents(load_test_catalog(spark, sf_dir), buckets=P.BUCKETS)
    return docs.select("id", "part", "name", "description", join_values("film_ids").alias("film_ids"))


# ---- pages by an index of ranges -----------------------------------------------------------


@query
def change_feed_pages(spark, sf_dir):
    """The first, a middle and the last page of the feed since a mark, each row with its place in the order."""
    films = load_test_catalog(spark, sf_dir).film_work
    index = PI.write_page_index(films, ["modified", "id"], subdir(spark, "page_index", uuid.uuid4().hex), P.FEED_RANGES)
    since = C.ts(P.FILM_LO)
    start, last = index.places_before(since), index.pages(P.FEED_SIZE, since) - 1
    pages = [index.slice(start + n * P.FEED_SIZE, P.FEED_SIZE).withColumn("place", F.col("place") - start)
             .withColumn("page", F.lit(n)) for n in sorted({0, last // 2, last})]
    return _ts_str(reduce(DataFrame.unionByName, pages))


# ---- contains search by trigrams -------------------------------------------------------------


@query
def search_films_by_trigrams(spark, sf_dir):
    """Several admin searches over the films, candidates fetched by the rarest trigram of each term."""
    cat = load_test_catalog(spark, sf_dir)
    films = cat.film_work.select(*K.ADMIN_FILM_COLUMNS, "description")
    fields = list(K.FILM_SEARCH_FIELDS)
    postings = materialize(TG.trigram_postings(films, fields), "trigrams")
    found = [TG.search(films, postings, fields, q).withColumn("query", F.lit(q)) for q in P.GRAM_SEARCHES]
    return _admin(reduce(DataFrame.unionByName, found).select("query", *K.ADMIN_FILM_COLUMNS))


# ---- removals that reach the indexes -----------------------------------------------------------


@query
def reconciled_documents(spark, sf_dir):
    """The documents left in all indexes after films, people and genres vanish from the tables."""
    cat = load_test_catalog(spark, sf_dir)
    sinks = DocumentSinks(subdir(spark, "reconciled", uuid.uuid4().hex))
    SK.upsert(D.film_documents(cat), sinks.path("movies"), 0)
    SK.upsert(D.person_documents(cat), sinks.path("persons"), 0)
    SK.upsert(D.genre_documents(cat), sinks.path("genres"), 0)
    left = cat.with_(film_work=cat.film_work.where(~F.col("id").isin(*P.REMOVED_FILMS)),
                     person=cat.person.where(~F.col("id").isin(*P.REMOVED_PERSONS)),
                     genre=cat.genre.where(~F.col("id").isin(*P.REMOVED_GENRES)))
    reconcile(spark, left, sinks, 1)
    movies, persons, genres = (SK.current_view(spark, sinks.path(i)) for i in ("movies", "persons", "genres"))
    lists = F.concat_ws("|", *[join_refs(g) for g in D.DOC_GROUPS])
    return reduce(DataFrame.unionByName, [
        movies.select(F.lit("movies").alias("kind"), "id", lists.alias("entries")),
        persons.select(F.lit("persons").alias("kind"), "id", F.concat_ws("|", join_values("role"), join_values("film_ids")).alias("entries")),
        genres.select(F.lit("genres").alias("kind"), "id", join_values("film_ids").alias("entries"))])


# ---- sets kept by counts ------------------------------------------------------------------------


def _counted_genres(spark, sf_dir):
    """Films before FILM_LO, then the films since with the links of one day once more, then removals."""
    cat = load_test_catalog(spark, sf_dir)
    links = cat.genre_film_work_raw
    dated = links.join(cat.film_work.select(F.col("id").alias("film_work_id"), "modified"), "film_work_id")
    day = dated.where(F.col("modified").between(P.BATCH_DAY, P.BATCH_NEXT_DAY))
    store = CS.CountedSets(spark, subdir(spark, "counted", uuid.uuid4().hex), files=8)
    store.append(CS.signed(dated.where(F.col("modified") < P.FILM_LO), "genre_id"), 0)
    store.append(CS.signed(dated.where(F.col("modified") >= P.FILM_LO), "genre_id").unionByName(CS.signed(day, "genre_id")), 1)
    gone = links.where(F.col("film_work_id").isin(*P.REMOVED_FILMS))
    again = day.where(~F.col("film_work_id").isin(*P.REMOVED_FILMS))
    twice = day.where(F.col("film_work_id").isin(*P.REMOVED_FILMS))
    store.append(reduce(DataFrame.unionByName, [CS.signed(x, "genre_id", -1) for x in (gone, again, twice)]), 2)
    return store


@query
def counted_genre_films(spark, sf_dir):
    """The films of every genre after inserts, repeats and removals, with the number of their links."""
    return _counted_genres(spark, sf_dir).entries()


@query
def counted_genre_changes(spark, sf_dir):
    """What each batch added to the sets and retracted from them."""
    store = _counted_genres(spark, sf_dir)
    return reduce(DataFrame.unionByName, [store.changes(b).withColumn("batch", F.lit(b)) for b in (1, 2)])


@query
def counted_genre_parts(spark, sf_dir):
    """The parts of genre sets that the removals touched, rebuilt."""
    parts = _counted_genres(spark, sf_dir).parts(P.BUCKETS, changed_in=2)
    return parts.select("id", "part", join_values("film_ids").alias("film_ids"))


# ---- rejects of every table, places in an order ---------------------------------------------------


@query
def rejected_entities(spark, sf_dir):
    """Rejects of films, persons and genres, with values taken away so that there are some."""
    cat = load_test_catalog(spark, sf_dir)
    cat = cat.with_(film_work=cat.film_work.withColumn("title", F.nullif("title", F.lit(P.LOST_TITLE)))
                    .withColumn("type", F.nullif("type", F.lit(P.LOST_TYPE))),
                    person=cat.person.withColumn("full_name", F.when(F.col("modified") >= P.PERSON_LO, F.col("full_name"))),
                    genre=cat.genre.withColumn("name", F.nullif("name", F.lit(P.FILTER_GENRE_NAME))))
    return Q.rejected_entities(cat).withColumn("reasons", F.concat_ws(",", "reasons"))


@query
def film_cast_places(spark, sf_dir):
    order = ["film_work_id", "full_name", "person_id", "role"]
    return K.with_place(K.film_cast_ordered(load_test_catalog(spark, sf_dir)), order)


@query
def film_genres_places(spark, sf_dir):
    order = ["film_work_id", "name", "genre_id"]
    return K.with_place(K.film_genres_ordered(load_test_catalog(spark, sf_dir)), order)
