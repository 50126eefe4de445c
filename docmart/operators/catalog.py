"""Catalogue read queries: API list / detail / page metadata, admin search,
filters and orderings.

The API row is a film with name sets per genre and per role.  As in the
documents, the branches are reduced to distinct (film, group, name) entries
before joining, so the genre x person product is never built; an API body
is one row per film.  Pages select their 50 film ids
first (a top-k over the film table), then aggregate only those films' links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.search import all_terms_match
from ..schemas import PAGE_SIZE, ROLE_ACTOR, ROLE_DIRECTOR, ROLE_WRITER
from ..session import materialize

API_COLUMNS = ("id", "title", "description", "creation_date", "rating", "type")
API_ROLE_GROUPS = {"actors": ROLE_ACTOR, "directors": ROLE_DIRECTOR, "writers": ROLE_WRITER}


def _name_set(group: str):
    # distinct names of one group; a NULL name (dangling link, or the unlinked
    # film's genre) is kept; no entry -> []
    return F.array_sort(F.transform(
        F.collect_set(F.when(F.col("group") == group, F.struct(F.col("name").alias("v")))),
        lambda s: s["v"]))


def api_films(cat, film_ids: DataFrame | None = None) -> DataFrame:
    """API rows: film columns + genres, actors, directors, writers name sets, one row per film.

    As with the SQL left joins, a film without genre links gets genres=[NULL];
    without people of a role, [].  Names are distinct sets.
    """
    cat = cat.set_links()
    films = cat.film_work.select(*API_COLUMNS)
    pfw, gfw = cat.person_film_work, cat.genre_film_work
    if film_ids is not None:
        keys = film_ids.select(F.col(film_ids.columns[0]).alias("film_work_id"))
        films = films.join(keys.withColumnRenamed("film_work_id", "id"), "id", "left_semi")
        pfw = pfw.join(keys, "film_work_id", "left_semi")
        gfw = gfw.join(keys, "film_work_id", "left_semi")
    person = cat.person.select(F.col("id").alias("person_id"), F.col("full_name").alias("name"))
    genre = cat.genre.select(F.col("id").alias("genre_id"), "name")
    role_to_group = F.create_map(*[x for g, r in API_ROLE_GROUPS.items() for x in (F.lit(r), F.lit(g))])
    people = (pfw.where(F.col("role").isin(list(API_ROLE_GROUPS.values())))
                 .join(person, "person_id", "left")
                 .select("film_work_id", role_to_group[F.col("role")].alias("group"), "name"))
    genres = gfw.join(genre, "genre_id", "left").select("film_work_id", F.lit("genres").alias("group"), "name")
    # the left join's NULL row for a film without genre links, without a
    # film-preserving join on the (possibly hot) link side
    unlinked = (films.select(F.col("id").alias("film_work_id"))
                .join(gfw.select("film_work_id").distinct(), "film_work_id", "left_anti")
                .select("film_work_id", F.lit("genres").alias("group"), F.lit(None).cast("string").alias("name")))
    # duplicates collapse map-side in the partial collect_set (no distinct shuffle)
    entries = people.unionByName(genres).unionByName(unlinked)
    per_film = (entries.withColumnRenamed("film_work_id", "id").groupBy("id")
                .agg(_name_set("genres").alias("genres"), *[_name_set(g).alias(g) for g in API_ROLE_GROUPS]))
    empty = F.array().cast("array<string>")
    return films.join(per_film, "id", "left").select(
        *API_COLUMNS, F.coalesce("genres", empty).alias("genres"),
        *[F.coalesce(g, empty).alias(g) for g in API_ROLE_GROUPS])


def page_ids(film_work: DataFrame, page: int, size: int = PAGE_SIZE) -> DataFrame:
    """Ids of one 1-based page ordered by id (top-k plan, no full sort)."""
    return film_work.select("id").orderBy("id").offset((page - 1) * size).limit(size)


def resolve_page(cat, page: int | str, size: int = PAGE_SIZE) -> int:
    """A page number, or "last" (the count decides; one scalar to the driver)."""
    if page == "last":
        n = cat.film_work.count()
        return max(1, -(-n // size))
    return int(page)


def catalog_page(cat, page: int | str = 1, size: int = PAGE_SIZE) -> DataFrame:
    """``results`` of GET /movies/?page=N (or page=last): the page's films, ordered by id."""
    if page == "last":      # from the far end, so no task sorts more than a page
        n = cat.film_work.count()
        rest = n - max(0, -(-n // size) - 1) * size
        ids = cat.film_work.select("id").orderBy(F.desc("id")).limit(rest)
    else:
        ids = page_ids(cat.film_work, int(page), size)
    # the page is at most `size` ids: a proven bound, safe to broadcast
    return api_films(cat, F.broadcast(ids)).orderBy("id")


def catalog_page_after(cat, last_id=None, size: int = PAGE_SIZE) -> DataFrame:
    """The films that follow ``last_id`` (None: the first page), ordered by id.

    The way to read page after page however deep: every task keeps ``size`` ids
    and the id range is pushed to the scan.
    """
    films = cat.film_work if last_id is None else cat.film_work.where(F.col("id") > F.lit(last_id))
    return api_films(cat, F.broadcast(page_ids(films, 1, size))).orderBy("id")


def catalog_response(cat, page: int | str = 1, size: int = PAGE_SIZE) -> DataFrame:
    """(page, exists, body): the whole list response as one JSON text of count,
    total_pages, prev, next and results (the page's films, at most ``size``)."""
    number = resolve_page(cat, page, size)
    film = F.struct(*API_COLUMNS, "genres", *API_ROLE_GROUPS)
    films = catalog_page(cat, page, size).select(F.lit(number).alias("page"), film.alias("film"))
    head = ["count", "total_pages", "prev", "next"]
    rows = catalog_page_meta(cat, number, size).join(films, "page", "left")
    whole = rows.groupBy("page", "exists", *head).agg(F.array_sort(F.collect_list("film")).alias("results"))
    return whole.select("page", "exists", F.to_json(
        F.struct(*head, "results"), {"ignoreNullFields": "false"}).alias("body"))


def catalog_page_meta(cat, page: int | str = 1, size: int = PAGE_SIZE) -> DataFrame:
    """count, total_pages (>= 1), page, prev, next (NULL at the ends), exists."""
    page = resolve_page(cat, page, size)
    n = cat.film_work.agg(F.count(F.lit(1)).alias("count"))
    total = F.greatest(F.lit(1), F.ceil(F.col("count") / F.lit(size))).cast("int")
    p = F.lit(page)
    return n.select(
        "count",
        total.alias("total_pages"),
        p.alias("page"),
        F.when(p > 1, p - 1).cast("int").alias("prev"),
        F.when(p < total, p + 1).cast("int").alias("next"),
        ((p >= 1) & (p <= total)).alias("exists"),
    )


def catalog_detail(cat, film_id=None) -> DataFrame:
    """Detail rows with their JSON body; ``film_id`` selects one (pushed to the scans)."""
    films = cat.film_work
    if film_id is not None:
        films = films.where(F.col("id") == F.lit(film_id))
    rows = api_films(cat.with_(film_work=films), films.select("id") if film_id is not None else None)
    return rows.withColumn("body", F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}))


FILM_SEARCH_FIELDS = ("title", "description", "id")
PERSON_SEARCH_FIELDS = ("full_name",)
GENRE_SEARCH_FIELDS = ("name", "description")
ADMIN_FILM_COLUMNS = ("id", "title", "type", "creation_date", "rating")


def search_films(cat, query: str) -> DataFrame:
    return cat.film_work.where(all_terms_match(list(FILM_SEARCH_FIELDS), query)).select(*ADMIN_FILM_COLUMNS)


def search_people(cat, query: str) -> DataFrame:
    return cat.person.where(all_terms_match(list(PERSON_SEARCH_FIELDS), query)).select("id", "full_name")


def search_genres(cat, query: str) -> DataFrame:
    return cat.genre.where(all_terms_match(list(GENRE_SEARCH_FIELDS), query)).select("id", "name", "description")


def filter_films_by_type(cat, film_type: str) -> DataFrame:
    return cat.film_work.where(F.col("type") == film_type).select(*ADMIN_FILM_COLUMNS)


def filter_films_by_genre(cat, genre_ids: DataFrame) -> DataFrame:
    """Films linked to any of ``genre_ids`` (M:N membership as semi joins)."""
    keys = genre_ids.select(F.col(genre_ids.columns[0]).alias("genre_id"))
    films = cat.genre_film_work.join(keys, "genre_id", "left_semi").select(F.col("film_work_id").alias("id"))
    return cat.film_work.join(films, "id", "left_semi").select(*ADMIN_FILM_COLUMNS)


def genre_ids_named(cat, name: str) -> DataFrame:
    return cat.genre.where(F.col("name") == name).select("id")


def film_cast_ordered(cat) -> DataFrame:
    """Cast rows of every film ordered by (film, person name): a range-partitioned
    global sort, so one film with a huge cast is split across tasks."""
    person = cat.person.select(F.col("id").alias("person_id"), "full_name")
    return (cat.person_film_work.join(person, "person_id", "left")
               .select("film_work_id", "person_id", "full_name", "role")
               .orderBy("film_work_id", "full_name", "person_id", "role"))


def film_genres_ordered(cat) -> DataFrame:
    """Genre rows of every film ordered by (film, genre name), as the list of films prefetches them."""
    genre = cat.genre.select(F.col("id").alias("genre_id"), "name")
    return (cat.genre_film_work.join(genre, "genre_id", "left").select("film_work_id", "genre_id", "name")
               .orderBy("film_work_id", "name", "genre_id"))


def with_place(ordered: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``place``, the 0-based position in the total order by ``order``, without a sort in one task."""
    parts = materialize(ordered.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ordered")
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))        # a row per partition
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    nth = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return (parts.withColumn("_nth", nth).join(F.broadcast(before), "_part")
            .withColumn("place", (F.col("_before") + F.col("_nth")).cast("long")).drop("_part", "_nth", "_before"))


def films_by_title(cat) -> DataFrame:
    """Films sorted by exact title (the `title.raw` sort key), id breaks ties."""
    return cat.film_work.select("id", "title").orderBy("title", "id")
