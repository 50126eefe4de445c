"""Nested document builders: film, person and genre documents.

Plan shape (the point of this module): each M:N branch is reduced to film
grain *before* it meets the film table, so the person x genre fan-out of the
naive five-table join is never materialised.  Every aggregate is partial
(map-side combine); the de-duplication step groups by (film, role, name) so a
film with a huge cast is spread over many tasks before the final collect,
which only sees already-distinct names.  A document is one row, or a fixed
number of buckets that the caller sets for every key alike (see ``skew``); the
entry rows (``film_entries``) are the form without any collected array.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sets import empty_if_null, null_keeping_set, ref_names, sorted_refs
from ..schemas import ROLE_GROUPS
from .quality import valid_films
from .skew import bucket_of, grouped, parts_of, tasks_for, with_scalars


def _people(person: DataFrame) -> DataFrame:
    # person rows need id and full_name (model rule); an empty name is kept
    return (person.where(F.col("id").isNotNull() & F.col("full_name").isNotNull())
                  .select(F.col("id").alias("person_id"), F.col("full_name").alias("name")))


def _once(named: DataFrame, *also: str) -> DataFrame:
    """One entry per film, group and name, the smallest id."""
    return named.groupBy("film_work_id", *also, "group", "name").agg(F.min("id").alias("id"))


def named_people(person_film_work: DataFrame, person: DataFrame, groups=ROLE_GROUPS) -> DataFrame:
    """(film_work_id, group, name, id) of every link with a known role to a person that exists."""
    role_to_group = F.create_map(*[x for g, r in groups.items() for x in (F.lit(r), F.lit(g))])
    links = person_film_work.where(F.col("role").isin(list(groups.values())))
    return links.join(_people(person), "person_id").select(
        "film_work_id", role_to_group[F.col("role")].alias("group"), "name", F.col("person_id").alias("id"))


def named_genres(genre_film_work: DataFrame, genre: DataFrame) -> DataFrame:
    """(film_work_id, 'genres', name, id) of every link to a genre with a name."""
    g = (genre.where(F.col("id").isNotNull() & F.col("name").isNotNull() & (F.col("name") != ""))
              .select(F.col("id").alias("genre_id"), "name"))
    return genre_film_work.join(g, "genre_id").select("film_work_id", F.lit("genres").alias("group"), "name", F.col("genre_id").alias("id"))


def people_entries(person_film_work: DataFrame, person: DataFrame, groups=ROLE_GROUPS) -> DataFrame:
    """(film_work_id, group, name, id): one entry per film, role group and name.

    Links without a known role are ignored; links to a missing person are
    skipped (inner join).  People of one role sharing a name collapse to one
    entry, the smallest id wins.  Grouping by (film, role, name) spreads a
    film with a huge cast over many tasks; ``min`` combines map-side.
    """
    return _once(named_people(person_film_work, person, groups))


def genre_entries(genre_film_work: DataFrame, genre: DataFrame) -> DataFrame:
    """(film_work_id, 'genres', name, id): empty/NULL names skipped, by-name de-dup."""
    return _once(named_genres(genre_film_work, genre))


DOC_GROUPS = ("actors", "writers", "directors", "genres")


def _changed_only(cat, film_ids: DataFrame | None):
    """(films, person links, genre links), restricted to ``film_ids`` before any aggregation.

    What follows stays in the tasks of these joins, so for many ids their number grows with the links; few
    ids are left to the planner, which sends them to the links.
    """
    films = valid_films(cat.film_work)
    pfw, gfw = cat.person_film_work, cat.genre_film_work
    if film_ids is not None:
        keys = film_ids.select(F.col(film_ids.columns[0]).alias("film_work_id"))
        if tasks_for(keys) > 1:
            tasks = tasks_for(pfw, gfw)
            films, keys = films.repartition(tasks, "id"), keys.repartition(tasks, "film_work_id")
            pfw, gfw = pfw.repartition(tasks, "film_work_id"), gfw.repartition(tasks, "film_work_id")
        films = films.join(keys.withColumnRenamed("film_work_id", "id"), "id", "left_semi")
        pfw = pfw.join(keys, "film_work_id", "left_semi")
        gfw = gfw.join(keys, "film_work_id", "left_semi")
    return films, pfw, gfw


def film_entries(cat, film_ids: DataFrame | None = None) -> DataFrame:
    """(film_id, group, name, ref_id): the entries of the valid films' documents as rows.

    Nothing is collected, so a film or person of any size spreads over tasks.
    """
    films, pfw, gfw = _changed_only(cat.set_links(), film_ids)
    entries = people_entries(pfw, cat.person).unionByName(genre_entries(gfw, cat.genre))
    return (entries.join(films.select(F.col("id").alias("film_work_id")), "film_work_id", "left_semi")
            .select(F.col("film_work_id").alias("film_id"), "group", "name", F.col("id").alias("ref_id")))


def film_documents(cat, film_ids: DataFrame | None = None, buckets: int = 1) -> DataFrame:
    """Nested documents of valid films, ``buckets`` rows at most for each (see ``skew``).

    ``film_ids`` (a one-column DataFrame of ids) restricts the build to those
    films; the restriction is applied to the film table *and* to both link
    tables before any aggregation (left-semi joins), so an incremental rebuild
    only touches the links of the changed films.  The ids are counted, so they
    should be stored.
    """
    films, pfw, gfw = _changed_only(cat.set_links(), film_ids)
    aggs = [sorted_refs(F.collect_list(F.when(F.col("group") == g, F.struct("name", "id")))).alias(g)
            for g in DOC_GROUPS]
    base = films.select("id", "title", "description", F.col("rating").alias("imdb_rating"))
    if buckets > 1:
        # one shuffle by film and part: names once, lists and scalars all meet in its tasks
        named = (named_people(pfw, cat.person).unionByName(named_genres(gfw, cat.genre))
                 .withColumn("part", bucket_of(F.col("name"), buckets)).repartition("film_work_id", "part"))
        lists = _once(named, "part").groupBy("film_work_id", "part").agg(*aggs).withColumnRenamed("film_work_id", "id")
        docs = parts_of(base, lists, "id", buckets)
    else:
        entries = (people_entries(pfw, cat.person).unionByName(genre_entries(gfw, cat.genre))
                   .select(F.col("film_work_id").alias("fid"), "group", "name", "id"))
        per_part = grouped(entries, films.select(F.col("id").alias("fid")), "fid", "name", buckets, *aggs).withColumnRenamed("fid", "id")
        docs = with_scalars(base, per_part, buckets)
    id_type = dict(cat.film_work.dtypes)["id"]
    ref_t = {g: f"struct<id:{dict(cat.person.dtypes)['id']},name:string>" for g in DOC_GROUPS}
    ref_t["genres"] = f"struct<id:{dict(cat.genre.dtypes)['id']},name:string>"
    cols = [F.col("id").cast(id_type).alias("id"), "part", "title", "description", "imdb_rating"]
    for g in DOC_GROUPS:
        arr = empty_if_null(F.col(g), ref_t[g])
        cols += [arr.alias(g), ref_names(arr).alias(f"{g}_names")]
    return docs.select(*cols)


def _film_id_parts(links: DataFrame, heads: DataFrame, buckets: int) -> DataFrame:
    """(id, part, film_ids) from link rows (id, film_work_id); duplicates collapse map-side in the partial set."""
    return grouped(links.select("id", "film_work_id"), heads, "id", "film_work_id", buckets,
                   null_keeping_set("film_work_id", F.col("present")).alias("film_ids"))


def person_documents(cat, person_ids: DataFrame | None = None, buckets: int = 1) -> DataFrame:
    """person (left) links: distinct roles and film ids; NULL kept, so a person
    without links gets role=[NULL], film_ids=[NULL]."""
    cat = cat.set_links()
    people = cat.person.where(F.col("id").isNotNull() & F.col("full_name").isNotNull())
    links = cat.person_film_work.select(F.col("person_id").alias("id"), "role", "film_work_id")
    if person_ids is not None:
        keys = person_ids.select(F.col(person_ids.columns[0]).alias("id"))
        people = people.join(keys, "id", "left_semi")
        links = links.join(keys, "id", "left_semi")
    # a person's role set has at most four values: partial aggregation keeps it tiny
    roles = links.groupBy("id").agg(null_keeping_set("role").alias("role"))
    none = F.array(F.lit(None))
    id_t = dict(cat.film_work.dtypes)["id"]
    base = people.select("id", F.col("full_name").alias("name")).join(roles, "id", "left").select(
        "id", "name", F.coalesce("role", none.cast("array<string>")).alias("role"), F.col("role").isNull().alias("alone"))
    films = _film_id_parts(links, people.select("id"), buckets)
    return with_scalars(base, films, buckets).select(
        "id", "part", "name", "role",
        F.when(F.col("alone"), none.cast(f"array<{id_t}>")).otherwise(F.col("film_ids")).alias("film_ids"))


def genre_documents(cat, genre_ids: DataFrame | None = None, buckets: int = 1) -> DataFrame:
    """genre (inner) links: genres without films produce no document."""
    cat = cat.set_links()
    genres = cat.genre.where(F.col("id").isNotNull() & F.col("name").isNotNull())
    links = cat.genre_film_work.where(F.col("film_work_id").isNotNull()) \
        .select(F.col("genre_id").alias("id"), "film_work_id")
    if genre_ids is not None:
        keys = genre_ids.select(F.col(genre_ids.columns[0]).alias("id"))
        genres = genres.join(keys, "id", "left_semi")
        links = links.join(keys, "id", "left_semi")
    films = _film_id_parts(links, links.select("id").distinct(), buckets)
    return with_scalars(genres.select("id", "name", "description"), films, buckets, "inner") \
        .select("id", "part", "name", "description", "film_ids")


def film_link_rows(cat, film_ids: DataFrame | None = None) -> DataFrame:
    """Raw rows behind a film document, one per link (linear, not a product).

    The reference hydrates film x person-link x genre-link rows; that product
    is quadratic per film.  The same information is the tagged union of the
    two link branches, each left-joined to its entity: kind 'person' rows
    carry role/person, kind 'genre' rows carry the genre, and a film without
    any link keeps one row with kind NULL.
    """
    films = cat.film_work.select(F.col("id").alias("fw_id"), "title", "description", "rating",
                                 "type", "created", "modified")
    pfw, gfw = cat.person_film_work, cat.genre_film_work
    if film_ids is not None:
        keys = film_ids.select(F.col(film_ids.columns[0]).alias("film_work_id"))
        films = films.join(keys.withColumnRenamed("film_work_id", "fw_id"), "fw_id", "left_semi")
        pfw = pfw.join(keys, "film_work_id", "left_semi")
        gfw = gfw.join(keys, "film_work_id", "left_semi")
    person = cat.person.select(F.col("id").alias("person_id"), "full_name")
    genre = cat.genre.select(F.col("id").alias("genre_id"), "name")
    p_rows = pfw.join(person, "person_id", "left").select(
        F.col("film_work_id").alias("fw_id"), F.lit("person").alias("kind"), "role",
        F.col("person_id").alias("person_id"), "full_name",
        F.lit(None).cast(genre.schema["genre_id"].dataType).alias("genre_id"),
        F.lit(None).cast("string").alias("name"))
    g_rows = gfw.join(genre, "genre_id", "left").select(
        F.col("film_work_id").alias("fw_id"), F.lit("genre").alias("kind"),
        F.lit(None).cast("string").alias("role"),
        F.lit(None).cast(person.schema["person_id"].dataType).alias("person_id"),
        F.lit(None).cast("string").alias("full_name"), "genre_id", "name")
    links = p_rows.unionByName(g_rows)
    # links x film is an inner join (AQE may split a hot film on the link
    # side); films without links come from an anti join against the distinct
    # link keys, which partial aggregation keeps small and 1:1.
    linked = links.join(films, "fw_id", "inner")
    keys = (pfw.select(F.col("film_work_id").alias("fw_id"))
            .union(gfw.select("film_work_id")).distinct())     # straight from the links, before their joins
    unlinked = films.join(keys, "fw_id", "left_anti")
    for c, t in links.dtypes:
        if c != "fw_id":
            unlinked = unlinked.withColumn(c, F.lit(None).cast(t))
    return linked.unionByName(unlinked)
