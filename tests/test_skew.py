"""Fixed buckets: one rule for every key; the buckets together hold exactly the whole set."""

import pytest

from docmart.operators import documents as D
from docmart.operators import text_index as TX
from docmart.sources import sinks as SK

from .fixtures import film, genre, glink, make_catalog, person, plink


def _catalog(spark):
    films = [film(f"f{i:02d}") for i in range(20)]
    return make_catalog(
        spark, films=films, persons=[person("hot", "Star"), person("p1", "Cold"), person("p2", "Alone")],
        genres=[genre("g", "Drama")],
        plinks=[plink(f"f{i:02d}", "hot", "actor") for i in range(20)] + [plink("f00", "p1", "actor")] * 20,
        glinks=[glink(f"f{i:02d}", "g") for i in range(20)])


@pytest.mark.parametrize("buckets", [1, 4])
def test_buckets_hold_the_whole_set_once(spark, buckets):
    cat = _catalog(spark)
    for docs, key in ((D.person_documents(cat, buckets=buckets), "hot"), (D.genre_documents(cat, buckets=buckets), "g")):
        rows = [r.asDict() for r in docs.collect() if r["id"] == key]
        ids = [v for r in rows for v in r["film_ids"]]
        assert sorted(ids) == [f"f{i:02d}" for i in range(20)]
        assert len(rows) == buckets
        assert [r["part"] for r in rows if r["name"] is not None] == [0]     # the head alone has the scalar fields
        assert all(r["film_ids"] == sorted(r["film_ids"]) for r in rows)


@pytest.mark.parametrize("buckets", [1, 4])
def test_copies_of_a_link_change_nothing_and_every_document_has_its_head(spark, buckets):
    rows = D.person_documents(_catalog(spark), buckets=buckets).collect()
    cold = {r["part"]: r for r in rows if r["id"] == "p1"}
    assert cold[0]["name"] == "Cold" and cold[0]["role"] == ["actor"]
    assert [v for r in cold.values() for v in r["film_ids"]] == ["f00"]
    alone = [r for r in rows if r["id"] == "p2"]
    assert [(r["part"], r["role"], r["film_ids"]) for r in alone] == [(0, [None], [None])]
    ids = {r._id for r in SK.bulk_actions(D.person_documents(_catalog(spark), buckets=buckets), "persons").collect()}
    assert {"hot", "p1", "p2"} <= ids and len(ids) == len(rows)


def test_film_buckets_keep_name_dedup_and_titles_once(spark):
    ps = [person(f"p{i:02d}", f"N{i % 12:02d}") for i in range(24)]   # 12 names, two ids each
    cat = make_catalog(spark, films=[film("big"), film("none")], persons=ps,
                       plinks=[plink("big", f"p{i:02d}", "actor") for i in range(24)])
    docs = D.film_documents(cat, buckets=3)
    rows = [r.asDict(recursive=True) for r in docs.collect()]
    actors = [(a["id"], a["name"]) for r in rows if r["id"] == "big" for a in r["actors"]]
    assert sorted(actors) == [(f"p{i:02d}", f"N{i:02d}") for i in range(12)]   # min id per name, once
    assert [(r["part"], r["title"], r["actors"]) for r in rows if r["id"] == "none"] == [(0, "T", [])]
    titles = TX.film_field_tokens(docs).where("field = 'title'").groupBy("id").count().collect()
    assert {(r["id"], r["count"]) for r in titles} == {("big", 1), ("none", 1)}
    entries = [(r.film_id, r.group, r.name, r.ref_id) for r in D.film_entries(cat).collect()]
    assert sorted(entries) == [("big", "actors", f"N{i:02d}", f"p{i:02d}") for i in range(12)]


def test_current_view_drops_stale_parts(spark, scratch):
    path = f"{scratch}/genres"
    v1 = spark.createDataFrame([("g", 0, ["a"]), ("g", 1, ["b"]), ("g", 2, ["c"])], "id string, part int, film_ids array<string>")
    v2 = spark.createDataFrame([("g", 0, ["a", "b", "c"])], "id string, part int, film_ids array<string>")
    SK.upsert(v1, path, 1)
    SK.upsert(v2, path, 2)
    assert [(r.part, r.film_ids) for r in SK.current_view(spark, path).collect()] == [(0, ["a", "b", "c"])]
    ids = sorted(r._id for r in SK.bulk_actions(v1, "genres").collect())
    assert ids == ["g", "g#1", "g#2"]
