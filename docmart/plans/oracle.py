"""DuckDB SQL twins of the registered queries (run on the raw test tables).

``MAPPING`` restates the test-table mapping of ``sources.tables`` as CTEs;
every oracle starts from it.
"""

from __future__ import annotations

from . import params as P

MAPPING = """
film_work AS (
  SELECT o_orderkey AS id, o_orderpriority AS title, CAST(NULL AS VARCHAR) AS description,
         CAST(o_orderdate AS DATE) AS creation_date, CAST(NULL AS VARCHAR) AS certificate,
         o_totalprice AS rating, o_orderstatus AS type, o_orderdate AS created, o_orderdate AS modified
  FROM orders),
person AS (
  SELECT s_suppkey AS id, s_name AS full_name,
         TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST(s_nationkey * 100 AS INTEGER)) AS modified
  FROM supplier),
genre AS (
  SELECT p_partkey AS id, p_name AS name, CAST(NULL AS VARCHAR) AS description,
         TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST(p_size * 50 AS INTEGER)) AS modified
  FROM part),
person_film_work_raw AS (
  SELECT l_orderkey AS film_work_id, l_suppkey AS person_id,
         CASE l_returnflag WHEN 'A' THEN 'actor' WHEN 'N' THEN 'producer' ELSE 'director' END AS role
  FROM lineitem),
genre_film_work_raw AS (SELECT l_orderkey AS film_work_id, l_partkey AS genre_id FROM lineitem),
person_film_work AS (SELECT DISTINCT * FROM person_film_work_raw),
genre_film_work AS (SELECT DISTINCT * FROM genre_film_work_raw),
valid_film AS (
  SELECT * FROM film_work
  WHERE id IS NOT NULL AND title IS NOT NULL AND type IS NOT NULL
    AND created IS NOT NULL AND modified IS NOT NULL)
"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([MAPPING.strip(), *[c.strip() for c in ctes]]) + "\n"


def _role_aggs() -> str:
    parts = []
    for group, role in (("actors", "actor"), ("writers", "producer"), ("directors", "director")):
        parts.append(f"string_agg(CAST(id AS VARCHAR) || ':' || name, ',' ORDER BY name, id) "
                     f"FILTER (WHERE role = '{role}') AS {group}")
        parts.append(f"string_agg(name, ',' ORDER BY name) FILTER (WHERE role = '{role}') AS {group}_names")
    return ",\n    ".join(parts)


def film_docs_ctes(film_filter: str = "") -> list[str]:
    """CTEs `people_agg`, `genre_agg`, `film_docs` (optionally restricted)."""
    return [
        f"""people AS (
  SELECT pfw.film_work_id, pfw.role, p.full_name AS name, min(p.id) AS id
  FROM person_film_work pfw JOIN person p ON p.id = pfw.person_id
  WHERE pfw.role IN ('actor', 'producer', 'director') AND p.full_name IS NOT NULL {film_filter.replace('{fw}', 'pfw.film_work_id')}
  GROUP BY 1, 2, 3)""",
        f"""people_agg AS (
  SELECT film_work_id,
    {_role_aggs()}
  FROM people GROUP BY 1)""",
        f"""genres AS (
  SELECT gfw.film_work_id, g.name, min(g.id) AS id
  FROM genre_film_work gfw JOIN genre g ON g.id = gfw.genre_id
  WHERE g.name IS NOT NULL AND g.name <> '' {film_filter.replace('{fw}', 'gfw.film_work_id')}
  GROUP BY 1, 2)""",
        """genre_agg AS (
  SELECT film_work_id,
    string_agg(CAST(id AS VARCHAR) || ':' || name, ',' ORDER BY name, id) AS genres,
    string_agg(name, ',' ORDER BY name) AS genres_names
  FROM genres GROUP BY 1)""",
        f"""film_docs AS (
  SELECT f.id, 0 AS part, f.title, f.description, f.rating AS imdb_rating,
    coalesce(pa.actors, '') AS actors, coalesce(pa.actors_names, '') AS actors_names,
    coalesce(pa.writers, '') AS writers, coalesce(pa.writers_names, '') AS writers_names,
    coalesce(pa.directors, '') AS directors, coalesce(pa.directors_names, '') AS directors_names,
    coalesce(ga.genres, '') AS genres, coalesce(ga.genres_names, '') AS genres_names
  FROM valid_film f
  LEFT JOIN people_agg pa ON pa.film_work_id = f.id
  LEFT JOIN genre_agg ga ON ga.film_work_id = f.id
  WHERE TRUE {film_filter.replace('{fw}', 'f.id')})""",
    ]


ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["film_documents"] = _with(*film_docs_ctes()) + "SELECT * FROM film_docs"

ORACLE_SQL["document_array_metrics"] = _with(*film_docs_ctes(), """
film_counts AS (
  SELECT f.id,
    count(p.id) FILTER (WHERE p.role = 'actor') AS actors,
    count(p.id) FILTER (WHERE p.role = 'producer') AS writers,
    count(p.id) FILTER (WHERE p.role = 'director') AS directors
  FROM valid_film f LEFT JOIN people p ON p.film_work_id = f.id GROUP BY f.id)""", """
genre_counts AS (
  SELECT f.id, count(g.id) AS genres FROM valid_film f LEFT JOIN genres g ON g.film_work_id = f.id GROUP BY f.id)""") + """
SELECT 'film.actors' AS metric, CAST(max(actors) AS INTEGER) AS value FROM film_counts
UNION ALL SELECT 'film.writers', CAST(max(writers) AS INTEGER) FROM film_counts
UNION ALL SELECT 'film.directors', CAST(max(directors) AS INTEGER) FROM film_counts
UNION ALL SELECT 'film.genres', CAST(max(genres) AS INTEGER) FROM genre_counts
UNION ALL SELECT 'person.film_ids', CAST(max(n) AS INTEGER) FROM (
  SELECT p.id, greatest(count(DISTINCT l.film_work_id), 1) AS n
  FROM person p LEFT JOIN person_film_work l ON l.person_id = p.id WHERE p.full_name IS NOT NULL GROUP BY p.id)
UNION ALL SELECT 'genre.film_ids', CAST(max(n) AS INTEGER) FROM (
  SELECT g.id, count(DISTINCT l.film_work_id) AS n
  FROM genre g JOIN genre_film_work l ON l.genre_id = g.id WHERE g.name IS NOT NULL GROUP BY g.id)"""

def person_docs_sql(person_filter: str = "", ctes=()) -> str:
    return _with(*ctes, f"""
roles AS (
  SELECT p.id, p.full_name AS name,
    string_agg(coalesce(r.role, '<null>'), ',' ORDER BY r.role NULLS LAST) AS role
  FROM person p
  LEFT JOIN (SELECT DISTINCT person_id, role FROM person_film_work) r ON r.person_id = p.id
  WHERE p.full_name IS NOT NULL {person_filter} GROUP BY 1, 2)""", f"""
films AS (
  SELECT p.id,
    string_agg(coalesce(CAST(f.film_work_id AS VARCHAR), '<null>'), ',' ORDER BY f.film_work_id NULLS LAST) AS film_ids
  FROM person p
  LEFT JOIN (SELECT DISTINCT person_id, film_work_id FROM person_film_work) f ON f.person_id = p.id
  WHERE p.full_name IS NOT NULL {person_filter} GROUP BY 1)""") + """
SELECT r.id, 0 AS part, r.name, r.role, f.film_ids FROM roles r JOIN films f ON f.id = r.id"""


def genre_docs_sql(genre_filter: str = "", ctes=()) -> str:
    return _with(*ctes) + f"""
SELECT g.id, 0 AS part, g.name, g.description,
  string_agg(CAST(l.film_work_id AS VARCHAR), ',' ORDER BY l.film_work_id) AS film_ids
FROM genre g JOIN (SELECT DISTINCT genre_id, film_work_id FROM genre_film_work) l ON l.genre_id = g.id
WHERE g.name IS NOT NULL {genre_filter}
GROUP BY g.id, g.name, g.description"""


ORACLE_SQL["person_documents"] = person_docs_sql()
ORACLE_SQL["genre_documents"] = genre_docs_sql()

ORACLE_SQL["film_wide_rows"] = _with("""
links AS (
  SELECT l.film_work_id AS fw_id, 'person' AS kind, l.role, l.person_id, p.full_name,
         CAST(NULL AS BIGINT) AS genre_id, CAST(NULL AS VARCHAR) AS name
  FROM person_film_work l LEFT JOIN person p ON p.id = l.person_id
  UNION ALL
  SELECT l.film_work_id, 'genre', NULL, NULL, NULL, l.genre_id, g.name
  FROM genre_film_work l LEFT JOIN genre g ON g.id = l.genre_id)""") + """
SELECT f.id AS fw_id, f.title, f.description, f.rating, f.type,
  CAST(f.created AS VARCHAR) AS created, CAST(f.modified AS VARCHAR) AS modified,
  l.kind, l.role, l.person_id, l.full_name, l.genre_id, l.name
FROM film_work f LEFT JOIN links l ON l.fw_id = f.id"""


# ---- change detection -------------------------------------------------------
def _win(col: str, lo: str, hi: str | None) -> str:
    s = f"{col} >= TIMESTAMP '{lo}'"
    return s + (f" AND {col} < TIMESTAMP '{hi}'" if hi else "")


CHANGED_CTES = [
    f"changed_genre AS (SELECT id FROM genre WHERE {_win('modified', P.GENRE_LO, P.GENRE_HI)})",
    f"changed_person AS (SELECT id FROM person WHERE {_win('modified', P.PERSON_LO, P.PERSON_HI)})",
    f"""films_for_genre AS (
  SELECT DISTINCT f.id, f.modified FROM film_work f JOIN genre_film_work l ON l.film_work_id = f.id
  WHERE l.genre_id IN (SELECT id FROM changed_genre))""",
    f"""films_for_person AS (
  SELECT DISTINCT f.id, f.modified FROM film_work f JOIN person_film_work l ON l.film_work_id = f.id
  WHERE l.person_id IN (SELECT id FROM changed_person))""",
    f"""changed_films AS (
  SELECT id FROM films_for_genre UNION SELECT id FROM films_for_person
  UNION SELECT id FROM film_work WHERE {_win('modified', P.FILM_LO, P.FILM_HI)})""",
]

ORACLE_SQL["changed_ids"] = _with() + f"""
SELECT id, CAST(modified AS VARCHAR) AS modified FROM film_work WHERE {_win('modified', P.FILM_LO, P.FILM_HI)}"""

ORACLE_SQL["changed_ids_page"] = _with() + f"""
SELECT id, CAST(modified AS VARCHAR) AS modified FROM film_work WHERE {_win('modified', P.FILM_LO, None)}
ORDER BY modified, id LIMIT 100 OFFSET 200"""

ORACLE_SQL["film_ids_for_genre"] = _with(*CHANGED_CTES) + \
    "SELECT id, CAST(modified AS VARCHAR) AS modified FROM films_for_genre"
ORACLE_SQL["film_ids_for_person"] = _with(*CHANGED_CTES) + \
    "SELECT id, CAST(modified AS VARCHAR) AS modified FROM films_for_person"
ORACLE_SQL["changed_film_ids"] = _with(*CHANGED_CTES) + "SELECT id FROM changed_films"
ORACLE_SQL["incremental_person_documents"] = person_docs_sql(
    "AND p.id IN (SELECT id FROM changed_person)", CHANGED_CTES[:2])
ORACLE_SQL["incremental_genre_documents"] = genre_docs_sql(
    "AND g.id IN (SELECT id FROM changed_genre)", CHANGED_CTES[:2])
ORACLE_SQL["incremental_film_documents"] = _with(
    *CHANGED_CTES, *film_docs_ctes("AND {fw} IN (SELECT id FROM changed_films)")) + "SELECT * FROM film_docs"


# ---- catalogue ---------------------------------------------------------------
def _api_people_aggs() -> str:
    return ",\n    ".join(
        f"coalesce(string_agg(coalesce(full_name, '<null>'), ',' ORDER BY full_name NULLS LAST) "
        f"FILTER (WHERE role = '{role}'), '') AS {group}"
        for group, role in (("actors", "actor"), ("directors", "director"), ("writers", "producer")))


API_CTES = [
    f"""api_people AS (
  SELECT id, {_api_people_aggs()}
  FROM (SELECT DISTINCT l.film_work_id AS id, l.role, p.full_name
        FROM person_film_work l LEFT JOIN person p ON p.id = l.person_id)
  GROUP BY id)""",
    """api_genres AS (
  SELECT id, string_agg(coalesce(name, '<null>'), ',' ORDER BY name NULLS LAST) AS genres
  FROM (SELECT DISTINCT l.film_work_id AS id, g.name
        FROM genre_film_work l LEFT JOIN genre g ON g.id = l.genre_id)
  GROUP BY id)""",
    """api AS (
  SELECT f.id, f.title, f.description, CAST(f.creation_date AS VARCHAR) AS creation_date, f.rating, f.type,
    coalesce(ag.genres, '<null>') AS genres, coalesce(ap.actors, '') AS actors,
    coalesce(ap.directors, '') AS directors, coalesce(ap.writers, '') AS writers
  FROM film_work f LEFT JOIN api_genres ag ON ag.id = f.id LEFT JOIN api_people ap ON ap.id = f.id)""",
]

ORACLE_SQL["catalog_list"] = _with(*API_CTES) + \
    f"SELECT * FROM api ORDER BY id LIMIT 50 OFFSET {(P.PAGE - 1) * 50}"
ORACLE_SQL["catalog_page_meta"] = _with() + f"""
SELECT count, total_pages, {P.PAGE} AS page,
  CAST(CASE WHEN {P.PAGE} > 1 THEN {P.PAGE} - 1 END AS INTEGER) AS prev,
  CAST(CASE WHEN {P.PAGE} < total_pages THEN {P.PAGE} + 1 END AS INTEGER) AS next,
  ({P.PAGE} >= 1 AND {P.PAGE} <= total_pages) AS "exists"
FROM (SELECT count(*) AS count, CAST(greatest(1, ceil(count(*) / 50.0)) AS INTEGER) AS total_pages FROM film_work)"""
ORACLE_SQL["catalog_detail"] = _with(*API_CTES) + "SELECT * FROM api"


def _terms(fields: list[str], q: str) -> str:
    per = []
    for t in q.split():
        per.append("(" + " OR ".join(f"CAST({f} AS VARCHAR) ILIKE '%{t}%'" for f in fields) + ")")
    return " AND ".join(per) or "TRUE"


ADMIN_COLS = "id, title, type, CAST(creation_date AS VARCHAR) AS creation_date, rating"
ORACLE_SQL["search_films"] = _with() + \
    f"SELECT {ADMIN_COLS} FROM film_work WHERE {_terms(['title', 'description', 'id'], P.FILM_SEARCH)}"
ORACLE_SQL["search_people"] = _with() + \
    f"SELECT id, full_name FROM person WHERE {_terms(['full_name'], P.PERSON_SEARCH)}"
ORACLE_SQL["search_genres"] = _with() + \
    f"SELECT id, name, description FROM genre WHERE {_terms(['name', 'description'], P.GENRE_SEARCH)}"
ORACLE_SQL["filter_films_by_type"] = _with() + \
    f"SELECT {ADMIN_COLS} FROM film_work WHERE type = '{P.FILTER_TYPE}'"
ORACLE_SQL["filter_films_by_genre"] = _with() + f"""
SELECT {ADMIN_COLS} FROM film_work WHERE id IN (
  SELECT film_work_id FROM genre_film_work WHERE genre_id IN (
    SELECT id FROM genre WHERE name = '{P.FILTER_GENRE_NAME}'))"""
ORACLE_SQL["film_cast_ordered"] = _with() + """
SELECT l.film_work_id, l.person_id, p.full_name, l.role
FROM person_film_work l LEFT JOIN person p ON p.id = l.person_id"""
ORACLE_SQL["films_by_title"] = _with() + "SELECT id, title FROM film_work"


# ---- data quality --------------------------------------------------------------
FILM_ROW_COLS = """id, title, description, CAST(creation_date AS VARCHAR) AS creation_date, rating, type,
  CAST(created AS VARCHAR) AS created, CAST(modified AS VARCHAR) AS modified"""
ORACLE_SQL["valid_films"] = _with() + f"SELECT {FILM_ROW_COLS} FROM valid_film"
ORACLE_SQL["rejected_films"] = _with() + f"""
SELECT {FILM_ROW_COLS},
  concat_ws(',', CASE WHEN id IS NULL THEN 'id is null' END, CASE WHEN title IS NULL THEN 'title is null' END,
    CASE WHEN type IS NULL THEN 'type is null' END, CASE WHEN created IS NULL THEN 'created is null' END,
    CASE WHEN modified IS NULL THEN 'modified is null' END) AS reasons
FROM film_work
WHERE id IS NULL OR title IS NULL OR type IS NULL OR created IS NULL OR modified IS NULL"""

_lo, _hi = P.RATING_RANGE
_types = ", ".join(f"'{t}'" for t in P.FILM_TYPES)
ORACLE_SQL["constraint_violations"] = _with() + f"""
SELECT 'film_work' AS table_name, CAST(id AS VARCHAR) AS key, 'title not null' AS rule FROM film_work WHERE title IS NULL
UNION ALL SELECT 'film_work', CAST(id AS VARCHAR), 'rating between {_lo:g} and {_hi:g}' FROM film_work
  WHERE NOT (rating BETWEEN {_lo} AND {_hi})
UNION ALL SELECT 'film_work', CAST(id AS VARCHAR), 'type in allowed set' FROM film_work WHERE type NOT IN ({_types})
UNION ALL SELECT 'film_work', CAST(id AS VARCHAR), 'type length <= 32' FROM film_work WHERE length(type) > 32
UNION ALL SELECT 'film_work', CAST(id AS VARCHAR), 'certificate length <= 512' FROM film_work WHERE length(certificate) > 512
UNION ALL SELECT 'person', CAST(id AS VARCHAR), 'full_name not null' FROM person WHERE full_name IS NULL
UNION ALL SELECT 'genre', CAST(id AS VARCHAR), 'name not null' FROM genre WHERE name IS NULL
UNION ALL SELECT 'genre', CAST(id AS VARCHAR), 'name length <= {P.GENRE_NAME_MAX}' FROM genre WHERE length(name) > {P.GENRE_NAME_MAX}
UNION ALL SELECT 'person_film_work', CAST(film_work_id AS VARCHAR) || '|' || CAST(person_id AS VARCHAR) || '|' || coalesce(role, ''),
  'role in allowed set' FROM person_film_work WHERE role NOT IN ('actor', 'producer', 'director')
UNION ALL SELECT 'film_work', CAST(id AS VARCHAR), 'primary key unique' FROM film_work GROUP BY id HAVING count(*) > 1
UNION ALL SELECT 'person', CAST(id AS VARCHAR), 'primary key unique' FROM person GROUP BY id HAVING count(*) > 1
UNION ALL SELECT 'genre', CAST(id AS VARCHAR), 'primary key unique' FROM genre GROUP BY id HAVING count(*) > 1"""

ORACLE_SQL["duplicate_links"] = _with() + """
SELECT 'genre_film_work' AS table_name, film_work_id, genre_id AS other_id, CAST(NULL AS VARCHAR) AS role, count(*) AS n
FROM genre_film_work_raw GROUP BY film_work_id, genre_id HAVING count(*) > 1
UNION ALL
SELECT 'person_film_work', film_work_id, person_id, role, count(*)
FROM person_film_work_raw WHERE role IS NOT NULL GROUP BY film_work_id, person_id, role HAVING count(*) > 1"""

ORACLE_SQL["orphan_links"] = _with() + """
SELECT 'person_film_work' AS table_name, film_work_id, person_id AS other_id, 'person' AS missing
FROM person_film_work WHERE person_id NOT IN (SELECT id FROM person)
UNION ALL SELECT 'person_film_work', film_work_id, person_id, 'film_work'
FROM person_film_work WHERE film_work_id NOT IN (SELECT id FROM film_work)
UNION ALL SELECT 'genre_film_work', film_work_id, genre_id, 'genre'
FROM genre_film_work WHERE genre_id NOT IN (SELECT id FROM genre)
UNION ALL SELECT 'genre_film_work', film_work_id, genre_id, 'film_work'
FROM genre_film_work WHERE film_work_id NOT IN (SELECT id FROM film_work)"""

_keys = ", ".join(f"'{k}'" for k in P.EVENT_KEYS)
_unknown = f"list_sort(list_distinct(list_filter(json_keys(props), lambda k: NOT list_contains([{_keys}], k))))"
ORACLE_SQL["strict_check"] = f"""
SELECT event_id, array_to_string({_unknown}, ',') AS unknown_keys, len({_unknown}) = 0 AS valid FROM events"""
ORACLE_SQL["strict_violations"] = f"SELECT * FROM ({ORACLE_SQL['strict_check']}) WHERE NOT valid"


# ---- sinks and streaming ---------------------------------------------------------
ORACLE_SQL["bulk_actions"] = _with("""
pdoc AS (
  SELECT p.id, p.full_name AS name,
    list(DISTINCT l.role ORDER BY l.role) AS role,
    list(DISTINCT l.film_work_id ORDER BY l.film_work_id) AS film_ids
  FROM person p JOIN person_film_work l ON l.person_id = p.id
  WHERE p.full_name IS NOT NULL GROUP BY 1, 2)""") + """
SELECT 'persons' AS _index, CAST(id AS VARCHAR) AS _id,
  CAST(to_json({'id': id, 'name': name, 'role': role, 'film_ids': film_ids}) AS VARCHAR) AS _source
FROM pdoc"""

ORACLE_SQL["latest_documents"] = """
SELECT user_id, event_id, CAST(ts AS VARCHAR) AS ts, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""


def _stream_changed_ctes() -> list[str]:
    return [
        f"changed_genre AS (SELECT id FROM genre WHERE {_win('modified', P.GENRE_LO, None)})",
        f"changed_person AS (SELECT id FROM person WHERE {_win('modified', P.PERSON_LO, None)})",
        """changed_films AS (
  SELECT film_work_id AS id FROM genre_film_work WHERE genre_id IN (SELECT id FROM changed_genre)
  UNION SELECT film_work_id FROM person_film_work WHERE person_id IN (SELECT id FROM changed_person)
  UNION SELECT id FROM film_work WHERE """ + _win('modified', P.FILM_LO, None) + ")",
    ]


ORACLE_SQL["stream_documents"] = _with(
    *_stream_changed_ctes(), *film_docs_ctes("AND {fw} IN (SELECT id FROM changed_films)")) + \
    "SELECT * FROM film_docs"


# ---- text ------------------------------------------------------------------------
from ..operators.text_index import ENGLISH_STOP, POSSESSIVE_PATTERN, RUSSIAN_STOP, TOKEN_PATTERN  # noqa: E402


def _sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def text_ctes(rus: str, source: str = "documents", ids: str = "doc_id", text: str = "text") -> list[str]:
    tok = TOKEN_PATTERN.replace("'", "''")
    poss = POSSESSIVE_PATTERN.replace("'", "''")
    return [
        f"""raw_tokens AS (
  SELECT {ids}, unnest(range(len(toks))) AS pos, unnest(toks) AS token
  FROM (SELECT {ids}, regexp_extract_all(lower({text}), '{tok}') AS toks FROM {source}))""",
        f"""tokens AS (
  SELECT {ids}, CAST(pos AS INTEGER) AS pos, token FROM (
    SELECT {ids}, pos, regexp_replace(token, '{poss}', '') AS token FROM raw_tokens
    WHERE token NOT IN ({_sql_list(ENGLISH_STOP)}))
  WHERE token NOT IN ({rus}) AND token <> '')""",
    ]


TEXT = text_ctes(_sql_list(RUSSIAN_STOP))
ORACLE_SQL["analysed_tokens"] = "WITH " + ",\n".join(TEXT) + "\nSELECT doc_id, pos, token FROM tokens"
ORACLE_SQL["term_postings"] = "WITH " + ",\n".join(TEXT) + """,
postings AS (SELECT token AS term, doc_id, count(*) AS tf FROM tokens GROUP BY 1, 2)
SELECT term, doc_id, tf, count(*) OVER (PARTITION BY term) AS df FROM postings"""

ORACLE_SQL["nested_match"] = _with(*film_docs_ctes()) + """
SELECT f.id AS film_id, a.name, a.id AS ref_id
FROM valid_film f
JOIN people a ON a.film_work_id = f.id AND a.role = 'actor'
JOIN people d ON d.film_work_id = f.id AND d.role = 'director' AND d.id = a.id AND d.name = a.name"""

ORACLE_SQL["films_of_person"] = _with(*film_docs_ctes()) + """
SELECT p.id AS person_id, p.film_work_id AS film_id,
  CASE p.role WHEN 'actor' THEN 'actors' WHEN 'producer' THEN 'writers' ELSE 'directors' END AS "group"
FROM people p JOIN valid_film f ON f.id = p.film_work_id"""


_FIELD_VALUES = """field_values AS (
  SELECT id, 'title' AS field, 0 AS value_index, title AS value FROM valid_film
  UNION ALL SELECT id, 'description', 0, description FROM valid_film
  UNION ALL
  SELECT p.film_work_id, CASE p.role WHEN 'actor' THEN 'actors_names' WHEN 'producer' THEN 'writers_names'
                                     ELSE 'directors_names' END,
    CAST(row_number() OVER (PARTITION BY p.film_work_id, p.role ORDER BY p.name) - 1 AS INTEGER), p.name
  FROM people p WHERE p.film_work_id IN (SELECT id FROM valid_film)
  UNION ALL
  SELECT g.film_work_id, 'genres_names',
    CAST(row_number() OVER (PARTITION BY g.film_work_id ORDER BY g.name) - 1 AS INTEGER), g.name
  FROM genres g WHERE g.film_work_id IN (SELECT id FROM valid_film))"""
ORACLE_SQL["film_field_tokens"] = _with(*film_docs_ctes(), _FIELD_VALUES, *text_ctes(
    _sql_list(RUSSIAN_STOP), "(SELECT * FROM field_values WHERE value IS NOT NULL)", "id, field, value_index",
    "value")) + "SELECT id, field, value_index, pos, token FROM tokens"


# ---- API detail body as JSON ---------------------------------------------------
def _api_list(group: str, role: str) -> str:
    return (f"coalesce(list(DISTINCT full_name ORDER BY full_name NULLS LAST) "
            f"FILTER (WHERE role = '{role}'), []::VARCHAR[]) AS {group}")


ORACLE_SQL["catalog_detail_json"] = _with(f"""
api_people_l AS (
  SELECT id, {_api_list('actors', 'actor')}, {_api_list('directors', 'director')},
    {_api_list('writers', 'producer')}
  FROM (SELECT DISTINCT l.film_work_id AS id, l.role, p.full_name
        FROM person_film_work l LEFT JOIN person p ON p.id = l.person_id)
  GROUP BY id)""", """
api_genres_l AS (
  SELECT id, list(DISTINCT name ORDER BY name NULLS LAST) AS genres
  FROM (SELECT DISTINCT l.film_work_id AS id, g.name
        FROM genre_film_work l LEFT JOIN genre g ON g.id = l.genre_id)
  GROUP BY id)""") + """
SELECT f.id, CAST(to_json({'id': f.id, 'title': f.title, 'description': f.description,
  'creation_date': f.creation_date, 'rating': f.rating, 'type': f.type,
  'genres': coalesce(ag.genres, [NULL]::VARCHAR[]), 'actors': coalesce(ap.actors, []::VARCHAR[]),
  'directors': coalesce(ap.directors, []::VARCHAR[]), 'writers': coalesce(ap.writers, []::VARCHAR[])}) AS VARCHAR) AS body
FROM film_work f LEFT JOIN api_genres_l ag ON ag.id = f.id LEFT JOIN api_people_l ap ON ap.id = f.id"""


# ---- bulk actions of the movies index (nested structs) ---------------------------
def _ref_list(role: str) -> str:
    return (f"coalesce(list({{'id': id, 'name': name}} ORDER BY name, id) FILTER (WHERE role = '{role}'), "
            f"[]::STRUCT(id BIGINT, name VARCHAR)[])")


def _name_list(role: str) -> str:
    return f"coalesce(list(name ORDER BY name) FILTER (WHERE role = '{role}'), []::VARCHAR[])"


ORACLE_SQL["bulk_actions_movies"] = _with(*film_docs_ctes(), f"""
people_l AS (
  SELECT film_work_id,
    {_ref_list('actor')} AS actors, {_name_list('actor')} AS actors_names,
    {_ref_list('producer')} AS writers, {_name_list('producer')} AS writers_names,
    {_ref_list('director')} AS directors, {_name_list('director')} AS directors_names
  FROM people GROUP BY 1)""", """
genres_l AS (
  SELECT film_work_id, list({'id': id, 'name': name} ORDER BY name, id) AS genres,
    list(name ORDER BY name) AS genres_names
  FROM genres GROUP BY 1)""") + """
SELECT 'movies' AS _index, CAST(f.id AS VARCHAR) AS _id,
  CAST(to_json({'id': f.id, 'title': f.title, 'description': f.description, 'imdb_rating': f.rating,
    'actors': coalesce(p.actors, []::STRUCT(id BIGINT, name VARCHAR)[]),
    'actors_names': coalesce(p.actors_names, []::VARCHAR[]),
    'writers': coalesce(p.writers, []::STRUCT(id BIGINT, name VARCHAR)[]),
    'writers_names': coalesce(p.writers_names, []::VARCHAR[]),
    'directors': coalesce(p.directors, []::STRUCT(id BIGINT, name VARCHAR)[]),
    'directors_names': coalesce(p.directors_names, []::VARCHAR[]),
    'genres': coalesce(g.genres, []::STRUCT(id BIGINT, name VARCHAR)[]),
    'genres_names': coalesce(g.genres_names, []::VARCHAR[])}) AS VARCHAR) AS _source
FROM valid_film f LEFT JOIN people_l p ON p.film_work_id = f.id LEFT JOIN genres_l g ON g.film_work_id = f.id"""


ORACLE_SQL["catalog_detail_by_id"] = f"SELECT * FROM ({ORACLE_SQL['catalog_detail_json']}) WHERE id = {P.DETAIL_ID}"


# ---- list response and last page --------------------------------------------------
ORACLE_SQL["catalog_response"] = f"""
SELECT CAST({P.PAGE} AS INTEGER) AS page, {P.PAGE} BETWEEN 1 AND t AS "exists",
  '{{"count":' || c || ',"total_pages":' || t
  || ',"prev":' || CASE WHEN {P.PAGE} > 1 THEN CAST({P.PAGE} - 1 AS VARCHAR) ELSE 'null' END
  || ',"next":' || CASE WHEN {P.PAGE} < t THEN CAST({P.PAGE} + 1 AS VARCHAR) ELSE 'null' END
  || ',"results":[' || coalesce((
    SELECT string_agg(body, ',' ORDER BY id) FROM (
      SELECT * FROM ({ORACLE_SQL['catalog_detail_json']}) ORDER BY id LIMIT 50 OFFSET {(P.PAGE - 1) * 50})), '')
  || ']}}' AS body
FROM (SELECT count(*) AS c, greatest(1, CAST(ceil(count(*) / 50.0) AS INTEGER)) AS t FROM orders)"""

ORACLE_SQL["catalog_last_page"] = f"""
SELECT * FROM ({ORACLE_SQL['catalog_detail']})
WHERE id IN (SELECT id FROM (SELECT o_orderkey AS id, row_number() OVER (ORDER BY o_orderkey) - 1 AS place,
                               count(*) OVER () AS n FROM orders)
             WHERE place // 50 = (n - 1) // 50)"""

# ---- text fields of the persons and genres indexes --------------------------------
ORACLE_SQL["person_field_tokens"] = _with(*text_ctes(_sql_list(RUSSIAN_STOP), """(
  SELECT id, 'name' AS field, 0 AS value_index, full_name AS value FROM person WHERE full_name IS NOT NULL)""",
    "id, field, value_index", "value")) + "SELECT id, field, value_index, pos, token FROM tokens"

ORACLE_SQL["genre_field_tokens"] = _with(*text_ctes(_sql_list(RUSSIAN_STOP), """(
  SELECT id, 'name' AS field, 0 AS value_index, name AS value FROM genre WHERE name IS NOT NULL
  UNION ALL SELECT id, 'description', 0, description FROM genre WHERE name IS NOT NULL AND description IS NOT NULL)""",
    "id, field, value_index", "value")) + "SELECT id, field, value_index, pos, token FROM tokens"


# ---- entry rows and fixed buckets ------------------------------------------------
ORACLE_SQL["film_entries"] = _with(*film_docs_ctes()) + """
SELECT p.film_work_id AS film_id, CASE p.role WHEN 'actor' THEN 'actors' WHEN 'producer' THEN 'writers'
    ELSE 'directors' END AS "group", p.name, p.id AS ref_id
FROM people p WHERE p.film_work_id IN (SELECT id FROM valid_film)
UNION ALL SELECT g.film_work_id, 'genres', g.name, g.id
FROM genres g WHERE g.film_work_id IN (SELECT id FROM valid_film)"""

ORACLE_SQL["person_documents_bucketed"] = _with(f"""
listed AS (
  SELECT p.id, l.film_work_id,
    CASE WHEN l.film_work_id IS NULL THEN 0
         ELSE CAST(CAST('0x' || substr(md5(CAST(l.film_work_id AS VARCHAR)), 1, 8) AS BIGINT) % {P.BUCKETS} AS INTEGER)
    END AS part
  FROM person p LEFT JOIN (SELECT DISTINCT person_id, film_work_id FROM person_film_work) l ON l.person_id = p.id
  WHERE p.full_name IS NOT NULL)""", """
parted AS (
  SELECT id, part, string_agg(coalesce(CAST(film_work_id AS VARCHAR), '<null>'), ',' ORDER BY film_work_id) AS film_ids
  FROM listed GROUP BY id, part
  UNION ALL
  SELECT id, 0, '' FROM listed GROUP BY id HAVING count(*) FILTER (WHERE part = 0) = 0)""", """
roles AS (
  SELECT p.id, p.full_name AS name, string_agg(coalesce(r.role, '<null>'), ',' ORDER BY r.role NULLS LAST) AS role
  FROM person p LEFT JOIN (SELECT DISTINCT person_id, role FROM person_film_work) r ON r.person_id = p.id
  WHERE p.full_name IS NOT NULL GROUP BY 1, 2)""") + """
SELECT d.id, d.part, CASE WHEN d.part = 0 THEN r.name END AS name, CASE WHEN d.part = 0 THEN r.role END AS role,
  d.film_ids
FROM parted d JOIN roles r ON r.id = d.id"""


# ---- one micro-batch of changes ----------------------------------------------------
def _ids(values) -> str:
    return ", ".join(map(str, values))


BATCH_CTES = [f"""batch_films AS (
  SELECT id FROM film_work WHERE modified >= TIMESTAMP '{P.BATCH_DAY}' AND modified < TIMESTAMP '{P.BATCH_NEXT_DAY}'
  UNION SELECT film_work_id FROM person_film_work WHERE person_id IN ({_ids(P.BATCH_PERSONS)})
  UNION SELECT film_work_id FROM genre_film_work WHERE genre_id IN ({_ids(P.BATCH_GENRES)}))"""]
ORACLE_SQL["batch_film_documents"] = _with(
    *BATCH_CTES, *film_docs_ctes("AND {fw} IN (SELECT id FROM batch_films)")) + \
    "SELECT * FROM film_docs WHERE id IN (SELECT id FROM batch_films)"
ORACLE_SQL["batch_person_documents"] = f"SELECT * FROM ({ORACLE_SQL['person_documents']}) WHERE id IN ({_ids(P.BATCH_PERSONS)})"
ORACLE_SQL["batch_genre_documents"] = f"SELECT * FROM ({ORACLE_SQL['genre_documents']}) WHERE id IN ({_ids(P.BATCH_GENRES)})"

# ---- element-level postings: names taken apart in every entry -----------------------
_ENTRY_TERMS = f"""
entry_terms AS (
  SELECT film_id, "group", ref_id AS element, regexp_extract_all(lower(name), '[\\p{{L}}\\p{{N}}]+') AS terms
  FROM ({ORACLE_SQL['film_entries']}))"""
ORACLE_SQL["element_postings"] = f"""
WITH {_ENTRY_TERMS}
SELECT unnest(terms) AS term, film_id, "group", element, CAST(unnest(range(len(terms))) AS INTEGER) AS pos FROM entry_terms"""
ORACLE_SQL["nested_name_and_id"] = f"""
WITH {_ENTRY_TERMS}
SELECT DISTINCT film_id, element FROM entry_terms
WHERE "group" = '{P.NESTED_GROUP}' AND element = {P.NESTED_ID} AND list_contains(terms, '{P.NESTED_TEXT}')"""
_NAMES_TERMS = ", ".join(f"'{t}'" for t in P.NAMES_TEXT.lower().split())
ORACLE_SQL["nested_name_terms"] = f"""
WITH {_ENTRY_TERMS}
SELECT DISTINCT film_id, element FROM entry_terms
WHERE "group" = '{P.NAMES_GROUP}' AND list_has_all(terms, [{_NAMES_TERMS}])"""
ORACLE_SQL["flat_name_terms"] = f"""
WITH {_ENTRY_TERMS}
SELECT film_id, bool_or(list_has_all(terms, [{_NAMES_TERMS}])) AS nested
FROM entry_terms WHERE "group" = '{P.NAMES_GROUP}'
GROUP BY film_id HAVING list_has_all(flatten(list(terms)), [{_NAMES_TERMS}])"""

# ---- strictness inside bodies: what the rule that makes the bodies puts in ------------
ORACLE_SQL["strict_bodies"] = """
SELECT id, unknown, unknown IS NULL AS valid FROM (
  SELECT o_orderkey AS id, CASE o_orderkey % 5
    WHEN 1 THEN CASE WHEN o_orderstatus IS NOT NULL THEN 'status' END
    WHEN 2 THEN 'maker.since'
    WHEN 3 THEN CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 2 AND l_quantity IS NOT NULL)
                     THEN 'lines.quantity' END
    WHEN 4 THEN '<body>' END AS unknown
  FROM orders)"""


# ---- stems: the Porter rules step by step ----------------------------------------------
def _stem_ctes(source: str) -> list[str]:
    """CTEs from ``source`` (t) to ``stems`` (t, stem)."""
    one, two = "'[aeiouy][^aeiouy]'", "'[aeiouy][^aeiouy]+[aeiouy]+[^aeiouy]'"
    short = "'[^aeiouy][aeiouy][^aeiouywxY]$'"

    def cut(n, w="w"):
        return f"substr({w}, 1, greatest(length({w}) - {n}, 0))"

    def rules(pairs, measure):
        cases = []
        for pair in sorted(pairs.split(), key=lambda x: -len(x.split(">")[0])):
            old, new = pair.split(">")
            also = f" AND regexp_matches({cut(3)}, '[st]$')" if old == "ion" else ""
            cases.append(f"WHEN ends_with(w, '{old}') THEN CASE WHEN regexp_matches({cut(len(old))}, {measure}){also} "
                         f"THEN {cut(len(old))} || '{new}' ELSE w END")
        return "CASE " + " ".join(cases) + " ELSE w END"

    second = ("ational>ate tional>tion enci>ence anci>ance izer>ize bli>ble alli>al entli>ent eli>e ousli>ous ization>ize "
              "ation>ate ator>ate alism>al iveness>ive fulness>ful ousness>ous aliti>al iviti>ive biliti>ble logi>log")
    third = "icate>ic ative> alize>al iciti>ic ical>ic ful> ness>"
    fourth = ("al> ance> ence> er> ic> able> ible> ant> ement> ment> ent> ion> ou> ism> ate> iti> ous> ive> ize>")
    steps = [
        f"CASE WHEN ends_with(w, 'sses') OR ends_with(w, 'ies') THEN {cut(2)} "
        f"WHEN ends_with(w, 's') AND NOT ends_with(w, 'ss') THEN {cut(1)} ELSE w END",
        f"""CASE WHEN ends_with(w, 'eed') THEN CASE WHEN regexp_matches({cut(3)}, {one}) THEN {cut(1)} ELSE w END
  WHEN ends_with(w, 'ed') AND regexp_matches({cut(2)}, '[aeiouy]') THEN {cut(2)} || '|'
  WHEN ends_with(w, 'ing') AND regexp_matches({cut(3)}, '[aeiouy]') THEN {cut(3)} || '|' ELSE w END""",
        f"""CASE WHEN NOT ends_with(w, '|') THEN w
  WHEN regexp_matches(w, '(at|bl|iz)\\|$') THEN {cut(1)} || 'e'
  WHEN substr(w, length(w) - 1, 1) = substr(w, length(w) - 2, 1) AND regexp_matches(w, '[^aeiouy]\\|$')
    THEN CASE WHEN regexp_matches(w, '[lsz]\\|$') THEN {cut(1)} ELSE {cut(2)} END
  WHEN regexp_matches({cut(1)}, {one}) AND NOT regexp_matches({cut(1)}, {two}) AND regexp_matches({cut(1)}, {short})
    THEN {cut(1)} || 'e' ELSE {cut(1)} END""",
        f"CASE WHEN regexp_matches(w, '[aeiouy].*[yY]$') THEN {cut(1)} || 'i' ELSE w END",
        rules(second, one), rules(third, one), rules(fourth, two),
        f"CASE WHEN ends_with(w, 'e') AND (regexp_matches({cut(1)}, {two}) OR regexp_matches({cut(1)}, {one}) "
        f"AND NOT regexp_matches({cut(1)}, {short})) THEN {cut(1)} ELSE w END",
        f"CASE WHEN ends_with(w, 'll') AND regexp_matches(w, {two}) THEN {cut(1)} ELSE w END",
    ]
    out = ["stem0 AS (SELECT t, regexp_replace(regexp_replace(t, '(^|[aeiou])y', '\\1Y', 'g'), 'yy', 'yY', 'g') AS w "
           f"FROM (SELECT DISTINCT t FROM {source}))"]
    for i, step in enumerate(steps):
        out.append(f"stem{i + 1} AS (SELECT t, {step} AS w FROM stem{i})")
    out.append(f"stems AS (SELECT t, CASE WHEN length(t) <= 2 THEN t ELSE replace(w, 'Y', 'y') END AS stem FROM stem{len(steps)})")
    return out


_RAW = TEXT[0]
ORACLE_SQL["term_stems"] = "WITH " + ",\n".join([_RAW, "words AS (SELECT token AS t FROM raw_tokens)", *_stem_ctes("words")]) + \
    "\nSELECT t AS term, stem FROM stems"
# no text of the test tables is Russian, so the Russian stemmer leaves their terms as they are
ORACLE_SQL["stemmed_postings"] = "WITH " + ",\n".join([
    _RAW, f"kept AS (SELECT doc_id, token AS t FROM raw_tokens WHERE token NOT IN ({_sql_list(ENGLISH_STOP)}))",
    *_stem_ctes("kept"),
    "final AS (SELECT doc_id, regexp_replace(stem, '[''’]s$', '') AS term FROM kept JOIN stems USING (t))",
    f"postings AS (SELECT term, doc_id, count(*) AS tf FROM final WHERE term NOT IN ({_sql_list(RUSSIAN_STOP)}) AND term <> '' "
    "GROUP BY 1, 2)"]) + "\nSELECT term, doc_id, tf, count(*) OVER (PARTITION BY term) AS df FROM postings"


# ---- documents in fixed buckets ----------------------------------------------------------
def _bucket(value: str) -> str:
    return f"CAST(CAST('0x' || substr(md5(CAST({value} AS VARCHAR)), 1, 8) AS BIGINT) % {P.BUCKETS} AS INTEGER)"


def _bucketed_group(group: str, role: str) -> str:
    return (f"coalesce(string_agg(CAST(e.ref AS VARCHAR) || ':' || e.name, ',' ORDER BY e.name, e.ref) FILTER (WHERE e.role = '{role}'), '') "
            f"AS {group}, coalesce(string_agg(e.name, ',' ORDER BY e.name) FILTER (WHERE e.role = '{role}'), '') AS {group}_names")


ORACLE_SQL["film_documents_bucketed"] = _with(*film_docs_ctes(), f"""
entries AS (
  SELECT film_work_id AS fid, role, name, id AS ref, {_bucket('name')} AS part FROM people
  UNION ALL SELECT film_work_id, 'genre', name, id, {_bucket('name')} FROM genres)""", """
parts AS (
  SELECT fid, part FROM entries WHERE fid IN (SELECT id FROM valid_film)
  UNION SELECT id, 0 FROM valid_film)""") + f"""
SELECT p.fid AS id, p.part, any_value(CASE WHEN p.part = 0 THEN f.title END) AS title,
  any_value(CASE WHEN p.part = 0 THEN f.description END) AS description,
  any_value(CASE WHEN p.part = 0 THEN f.rating END) AS imdb_rating,
  {_bucketed_group('actors', 'actor')}, {_bucketed_group('writers', 'producer')},
  {_bucketed_group('directors', 'director')}, {_bucketed_group('genres', 'genre')}
FROM parts p JOIN valid_film f ON f.id = p.fid LEFT JOIN entries e ON e.fid = p.fid AND e.part = p.part
GROUP BY p.fid, p.part"""

ORACLE_SQL["genre_documents_bucketed"] = _with(f"""
listed AS (
  SELECT DISTINCT genre_id AS id, film_work_id, {_bucket('film_work_id')} AS part
  FROM genre_film_work WHERE film_work_id IS NOT NULL)""", """
parted AS (
  SELECT id, part, string_agg(CAST(film_work_id AS VARCHAR), ',' ORDER BY film_work_id) AS film_ids FROM listed GROUP BY id, part
  UNION ALL SELECT id, 0, '' FROM listed GROUP BY id HAVING count(*) FILTER (WHERE part = 0) = 0)""") + """
SELECT g.id, d.part, CASE WHEN d.part = 0 THEN g.name END AS name, CASE WHEN d.part = 0 THEN g.description END AS description,
  d.film_ids
FROM parted d JOIN genre g ON g.id = d.id WHERE g.name IS NOT NULL"""

# ---- pages by place -----------------------------------------------------------------------
ORACLE_SQL["change_feed_pages"] = _with(f"""
feed AS (
  SELECT row_number() OVER (ORDER BY modified, id) - 1 AS place, id, modified, count(*) OVER () AS n
  FROM film_work WHERE id IS NOT NULL AND modified >= TIMESTAMP '{P.FILM_LO}')""") + f"""
SELECT CAST(place AS BIGINT) AS place, CAST(place // {P.FEED_SIZE} AS INTEGER) AS page, id, CAST(modified AS VARCHAR) AS modified
FROM feed
WHERE place // {P.FEED_SIZE} IN (0, ((n - 1) // {P.FEED_SIZE}) // 2, (n - 1) // {P.FEED_SIZE})"""

# ---- contains searches ----------------------------------------------------------------------
ORACLE_SQL["search_films_by_trigrams"] = _with() + "\nUNION ALL\n".join(
    f"SELECT '{q}' AS query, {ADMIN_COLS} FROM film_work WHERE {_terms(['title', 'description', 'id'], q)}"
    for q in P.GRAM_SEARCHES)

# the same documents, built from tables without the removed rows and their links
_LEFT = (MAPPING.replace("FROM orders)", f"FROM orders WHERE o_orderkey NOT IN ({', '.join(map(str, P.REMOVED_FILMS))}))")
         .replace("FROM supplier)", f"FROM supplier WHERE s_suppkey NOT IN ({', '.join(map(str, P.REMOVED_PERSONS))}))")
         .replace("FROM part)", f"FROM part WHERE p_partkey NOT IN ({', '.join(map(str, P.REMOVED_GENRES))}))")
         .replace("FROM lineitem),\ngenre_film_work_raw",
                  "FROM lineitem WHERE l_orderkey IN (SELECT id FROM film_work) AND l_suppkey IN (SELECT id FROM person)),\ngenre_film_work_raw")
         .replace("AS genre_id FROM lineitem)",
                  "AS genre_id FROM lineitem WHERE l_orderkey IN (SELECT id FROM film_work) AND l_partkey IN (SELECT id FROM genre))"))


def _left(sql: str) -> str:
    return sql.replace(MAPPING.strip(), _LEFT.strip())


ORACLE_SQL["reconciled_documents"] = f"""
SELECT 'movies' AS kind, id, concat_ws('|', actors, writers, directors, genres) AS entries FROM ({_left(ORACLE_SQL["film_documents"])})
UNION ALL SELECT 'persons', id, concat_ws('|', role, film_ids) FROM ({_left(person_docs_sql())})
UNION ALL SELECT 'genres', id, film_ids FROM ({_left(genre_docs_sql())})"""


# ---- sets kept by counts, rejects, places ---------------------------------------------------------

_GONE = ", ".join(map(str, P.REMOVED_FILMS))
ORACLE_SQL["counted_genre_films"] = _with() + f"""
SELECT genre_id AS id, film_work_id AS film_id, CAST(count(*) AS BIGINT) AS n
FROM genre_film_work_raw WHERE film_work_id NOT IN ({_GONE}) GROUP BY 1, 2"""
ORACLE_SQL["counted_genre_changes"] = _with() + f"""
SELECT l.genre_id AS id, l.film_work_id AS film_id, 'added' AS change, 1 AS batch
FROM genre_film_work l JOIN film_work f ON f.id = l.film_work_id WHERE f.modified >= TIMESTAMP '{P.FILM_LO}'
UNION ALL SELECT genre_id, film_work_id, 'retracted', 2 FROM genre_film_work WHERE film_work_id IN ({_GONE})"""
ORACLE_SQL["counted_genre_parts"] = _with(f"""
placed AS (
  SELECT genre_id AS id, film_work_id AS film_id,
    CAST(CAST('0x' || substr(md5(CAST(film_work_id AS VARCHAR)), 1, 8) AS BIGINT) % {P.BUCKETS} AS INTEGER) AS part
  FROM genre_film_work)""") + f"""
SELECT id, part, coalesce(string_agg(CAST(film_id AS VARCHAR), ',' ORDER BY film_id)
  FILTER (WHERE film_id NOT IN ({_GONE})), '') AS film_ids
FROM placed WHERE (id, part) IN (SELECT (id, part) FROM placed WHERE film_id IN ({_GONE})) GROUP BY 1, 2"""
ORACLE_SQL["rejected_entities"] = _with() + f"""
SELECT 'film_work' AS table_name, CAST(id AS VARCHAR) AS key,
  concat_ws(',', CASE WHEN title = '{P.LOST_TITLE}' THEN 'title is null' END, CASE WHEN type = '{P.LOST_TYPE}' THEN 'type is null' END) AS reasons
FROM film_work WHERE title = '{P.LOST_TITLE}' OR type = '{P.LOST_TYPE}'
UNION ALL SELECT 'person', CAST(id AS VARCHAR), 'full_name is null' FROM person WHERE modified < TIMESTAMP '{P.PERSON_LO}'
UNION ALL SELECT 'genre', CAST(id AS VARCHAR), 'name is null' FROM genre WHERE name = '{P.FILTER_GENRE_NAME}'"""
ORACLE_SQL["film_cast_places"] = _with() + """
SELECT l.film_work_id, l.person_id, p.full_name, l.role, row_number() OVER (
  ORDER BY l.film_work_id, p.full_name NULLS FIRST, l.person_id, l.role NULLS FIRST) - 1 AS place
FROM person_film_work l LEFT JOIN person p ON p.id = l.person_id"""
ORACLE_SQL["film_genres_places"] = _with() + """
SELECT l.film_work_id, l.genre_id, g.name, row_number() OVER (
  ORDER BY l.film_work_id, g.name NULLS FIRST, l.genre_id) - 1 AS place
FROM genre_film_work l LEFT JOIN genre g ON g.id = l.genre_id"""
