"""Work per task stays as large however the tables grow; what is shuffled or stemmed is no more than needed."""

import os
import re

import pytest
from pyspark.sql import functions as F

from docmart.operators import documents as D
from docmart.operators import skew
from docmart.operators import text_index as TX
from docmart.operators.quality import drop_orphans
from docmart.operators.stemming import english_stem
from docmart.sources import layouts as LY
from docmart.sources import sinks as SK
from docmart.streaming.incremental import DocumentSinks
from docmart.streaming.reconcile import reconcile
from tests.fixtures import film, genre, glink, make_catalog, person, plink

BUILD = {"movies": D.film_documents, "persons": D.person_documents, "genres": D.genre_documents}


def catalog(spark, films=12):
    return make_catalog(
        spark, [film(f"f{i:02d}", title=None if i == 5 else "T") for i in range(films)] + [film("f01", title="again"), film(None)],
        [person(f"p{i}", f"N{i % 3}") for i in range(6)] + [person("p7", None)], [genre("g1", "Drama"), genre("g2", ""), genre("g3", "Noir")],
        [plink(f"f{i:02d}", f"p{j}", r) for i in range(films) for j in range(8) for r in ("actor", "director")]
        + [plink("f00", "p1", "actor", id="again"), plink(None, "p1", "actor"), plink("gone", "p1", "actor")],
        [glink(f"f{i:02d}", f"g{1 + i % 4}") for i in range(films)])


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def plan_of(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_tasks_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 10)
    assert [skew.tasks_for(spark.range(n)) for n in (0, 10, 11, 100)] == [1, 1, 2, 10]


def test_a_rebuild_of_many_films_is_cut_into_tasks_by_rows(spark, monkeypatch, scratch, capsys):
    cat = catalog(spark)
    ids = spark.createDataFrame([(f"f{i:02d}",) for i in range(9)] + [("gone",)], "id string")
    want = D.film_documents(cat).where("id < 'f09'").localCheckpoint()
    few = D.film_documents(cat, ids)
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 4)
    many = D.film_documents(cat, ids)
    assert "REPARTITION_BY_NUM" not in plan_of(few, capsys)
    assert f"{-(-(cat.person_film_work.count() + cat.genre_film_work.count()) // 4)}), REPARTITION_BY_NUM" in plan_of(many, capsys)
    assert same(few, want) and same(many, want) and want.count() == 9


def test_links_of_a_reconciliation_are_cut_down_once(spark, monkeypatch, scratch):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 20)
    cat, sinks, passes = catalog(spark), DocumentSinks(scratch), []
    for index, build in BUILD.items():
        SK.upsert(build(cat), sinks.path(index), 0)
    monkeypatch.setattr("docmart.streaming.reconcile.drop_orphans", lambda c: passes.append(c) or drop_orphans(c))
    left = cat.with_(film_work=cat.film_work.where("id <> 'f02'"), person=cat.person.where("id <> 'p1'"))
    reconcile(spark, left, sinks, 1)
    assert passes[0].person_film_work.rdd.getNumPartitions() > 4
    for index, build in BUILD.items():
        assert same(SK.current_view(spark, sinks.path(index)).drop("batch_id"), build(drop_orphans(left))), index


def test_no_task_writes_two_buckets_of_a_layout(spark, tmp_path):
    cat = catalog(spark, films=90)
    LY.write_link_layout(cat, str(tmp_path), "even_links", buckets=8, spread=2)
    files = [re.match(r"part-(\d+)-.*_(\d+)\.c000", f) for f in os.listdir(tmp_path / "person_film_work_by_film_work_id") if f.endswith(".parquet")]
    owners = [m[1] for m in files]
    assert len(owners) == len(set(owners)) and {int(m[2]) for m in files} == set(range(8))


def test_buckets_of_a_layout_grow_with_the_links(spark, monkeypatch):
    cat = catalog(spark)
    assert LY.buckets_for(cat) == 16
    monkeypatch.setattr(LY, "ROWS_A_BUCKET", 10)
    assert LY.buckets_for(cat) == -(-cat.person_film_work_raw.count() // 10)


@pytest.mark.parametrize("buckets", [2, 5])
def test_bucketed_film_documents_are_shuffled_once(spark, buckets, capsys):
    cat = catalog(spark)
    docs = D.film_documents(cat, buckets=buckets)
    shuffled = re.findall(r"Exchange hashpartitioning\((?!person_id|genre_id)(\w+)#\d+, (\w+)", plan_of(docs, capsys))
    assert sorted(shuffled) == [("film_work_id", "part"), ("id", "part")]         # the links, and the heads
    whole = D.film_documents(cat).where("id is not null")
    for group in D.DOC_GROUPS:
        def entries(df):
            return df.select("id", F.explode_outer(group)).where("col is not null").distinct()
        assert same(entries(docs), entries(whole))
    assert same(docs.where("part = 0").select("id", "title", "imdb_rating"), whole.select("id", "title", "imdb_rating"))
    assert docs.where("part > 0 and (title is not null or size(actors) + size(directors) + size(genres) = 0)").count() == 0
    parts = docs.groupBy("id", "part").count().where("count > 1")
    assert {r["id"] for r in parts.collect()} == {"f01"}                # a repeated film repeats all its parts


def test_stemmers_run_over_the_vocabulary_alone(spark, capsys):
    docs = spark.createDataFrame([(1, "running runs Runner's running"), (2, "the runs"), (3, None)], "doc_id long, text string")
    tokens = TX.analysed_tokens(docs, english_stems=english_stem)
    assert "Aggregate" not in plan_of(tokens, capsys)      # the distinct words are written: no filter on stems gets below them
    assert sorted((r.doc_id, r.pos, r.token) for r in tokens.collect()) == [
        (1, 0, "run"), (1, 1, "run"), (1, 2, "runner'"), (1, 3, "run"), (2, 1, "run")]
