"""Removed parents leave no document and no entry behind."""

import pytest

from docmart.operators import documents as D
from docmart.operators.quality import drop_orphans
from docmart.sources.sinks import compact, current_view, remove, upsert
from docmart.streaming.incremental import DocumentSinks
from docmart.streaming.reconcile import differing_buckets, expected_rows, held_rows, reconcile
from tests.fixtures import film, genre, glink, make_catalog, person, plink, rows_by_id

BUILD = {"movies": D.film_documents, "persons": D.person_documents, "genres": D.genre_documents}


def catalog(spark, without=()):
    keep = lambda rows: [r for r in rows if r[0] not in without]
    return make_catalog(
        spark, keep([film("f1", description="d"), film("f2", rating=None), film("f3"), film("f4")]),
        keep([person("p1", "Ann"), person("p2", "Bob"), person("p3", "Cy"), person("p4", None)]),
        keep([genre("g1", "Drama"), genre("g2", "Noir"), genre("g3", "Unused")]),
        [plink("f1", "p1", "actor"), plink("f1", "p2", "director"), plink("f2", "p1", "actor"), plink("f2", "p1", "producer"),
         plink("f1", "p1", "actor", id="again"), plink("f3", "p2", None), plink("f3", "p4", "actor")],
        [glink("f1", "g1"), glink("f2", "g1"), glink("f2", "g2"), glink("f1", "g1", id="again")])


def written(spark, base, buckets):
    sinks = DocumentSinks(base, {i: buckets for i in BUILD})
    for index, build in BUILD.items():
        upsert(build(catalog(spark), buckets=buckets), sinks.path(index), 0)
    return sinks


def assert_same(spark, sinks, cat, buckets):
    for index, build in BUILD.items():
        got, want = current_view(spark, sinks.path(index)).drop("batch_id"), build(drop_orphans(cat), buckets=buckets)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, index


@pytest.mark.parametrize("buckets", [1, 3])
def test_removed_rows_leave_no_document_and_no_entry(spark, scratch, buckets):
    sinks = written(spark, scratch, buckets)
    same = catalog(spark)
    for index in BUILD:
        assert differing_buckets(expected_rows(same, index), held_rows(current_view(spark, sinks.path(index)), index)) == []
    assert reconcile(spark, same, sinks, 1) == {i: (0, 0) for i in BUILD}

    left = catalog(spark, {"f2", "p2", "g1"})
    # f1 loses two entries, p1 a film; g2 loses its only film
    assert reconcile(spark, left, sinks, 2) == {"movies": (1, 1), "persons": (1, 1), "genres": (0, 2)}
    assert_same(spark, sinks, left, buckets)
    assert reconcile(spark, left, sinks, 2) == {i: (0, 0) for i in BUILD}          # a repeated batch

    assert reconcile(spark, same, sinks, 3) == {"movies": (2, 0), "persons": (2, 0), "genres": (2, 0)}
    assert_same(spark, sinks, same, buckets)                                         # what comes back lives again


def test_empty_tables_empty_every_index(spark, scratch):
    sinks = written(spark, scratch, 1)
    none = catalog(spark, {"f1", "f2", "f3", "f4", "p1", "p2", "p3", "p4", "g1", "g2", "g3"})
    assert reconcile(spark, none, sinks, 1) == {"movies": (0, 4), "persons": (0, 3), "genres": (0, 2)}
    assert all(current_view(spark, sinks.path(i)).count() == 0 for i in BUILD)


def test_changed_scalars_are_seen(spark, scratch):
    sinks = written(spark, scratch, 1)
    cat = catalog(spark)
    films = cat.film_work.selectExpr("id", "if(id = 'f1', null, title) title", "if(id = 'f2', 'new', description) description",
                                     "creation_date", "certificate", "file_path", "if(id = 'f3', 1.5D, rating) rating",
                                     "type", "created", "modified")
    assert reconcile(spark, cat.with_(film_work=films), sinks, 1)["movies"] == (2, 1)      # f1 is not valid any more
    docs = rows_by_id(current_view(spark, sinks.path("movies")))
    assert set(docs) == {"f2", "f3", "f4"} and docs["f2"]["description"] == "new" and docs["f3"]["imdb_rating"] == 1.5


def test_tombstones_hold_until_a_later_version(spark, scratch):
    docs = spark.createDataFrame([("a", 1), ("b", 1)], "id string, n int")
    upsert(docs, f"{scratch}/t", 1)
    remove(docs.where("id = 'a'"), f"{scratch}/t", 2)
    assert [r["id"] for r in current_view(spark, f"{scratch}/t").collect()] == ["b"]
    compact(spark, f"{scratch}/t", f"{scratch}/compacted")
    assert [r["id"] for r in spark.read.parquet(f"{scratch}/compacted").collect()] == ["b"]
    upsert(docs.where("id = 'a'"), f"{scratch}/t", 3)
    assert {r["id"] for r in current_view(spark, f"{scratch}/t").collect()} == {"a", "b"}
