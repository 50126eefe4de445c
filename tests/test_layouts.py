"""Links stored by key: pruned reads, the join beyond a few keys, and runs that use them."""

import io
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from docmart.operators import documents as D
from docmart.sources import layouts as LY
from docmart.sources.sinks import current_view
from docmart.sources.tables import Catalog
from docmart.streaming.incremental import DocumentSinks, process_changes


@pytest.fixture(scope="module")
def catalog(spark):
    t = "timestamp_ntz'2024-01-01'"
    films = spark.sql(f"select id, concat('t', id) title, cast(null as string) description, date'2020-01-01' creation_date, "
                      f"cast(null as string) certificate, cast(null as string) file_path, 5.0D rating, 'movie' type, "
                      f"{t} created, {t} modified from range(200)")
    person = spark.sql(f"select id, concat('p', id) full_name, {t} created, {t} modified from range(50)")
    genre = spark.sql(f"select id, concat('g', id) name, cast(null as string) description, {t} created, {t} modified from range(20)")
    # person 0 has a third of all links
    pfw = spark.sql("select id % 200 film_work_id, if(id % 3 = 0, 0, id % 50) person_id, "
                    "element_at(array('actor','producer','director'), cast(id % 3 + 1 as int)) role from range(1500)")
    gfw = spark.sql("select id % 190 film_work_id, id % 19 genre_id from range(900)")
    return Catalog(films, person, genre, pfw, gfw, pfw, gfw)


@pytest.fixture(scope="module")
def layout(catalog, tmp_path_factory):
    return LY.write_link_layout(catalog, str(tmp_path_factory.mktemp("layout")), "test_links", buckets=16, spread=2)


def plan_of(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_few_keys_read_their_buckets_without_a_shuffle(spark, catalog, layout):
    keys = spark.createDataFrame([(3,), (7,), (7,), (None,)], "id long")
    rows = layout.links("person_film_work", "film_work_id", keys)
    want = catalog.person_film_work.where("film_work_id in (3, 7)")
    assert rows.exceptAll(want).count() == 0 and want.exceptAll(rows).count() == 0
    plan = plan_of(rows.groupBy("film_work_id").agg(F.max("role")))
    selected = re.search(r"SelectedBucketsCount: (\d+) out of 16", plan)
    assert selected and int(selected[1]) <= 2
    assert "Exchange" not in plan and "Join" not in plan       # not even for the aggregate
    files = {r[0].rsplit("_", 1)[1][:5] for r in rows.select(F.input_file_name()).distinct().collect()}
    assert 1 <= len(files) <= 2


def test_many_keys_join_and_leave_the_stored_side_in_place(spark, catalog, layout, monkeypatch):
    monkeypatch.setattr(LY, "FEW", 0)
    keys = catalog.person.where("id < 9").select("id")
    rows = layout.links("person_film_work", "person_id", keys)
    want = catalog.person_film_work.where("person_id < 9")
    assert rows.exceptAll(want).count() == 0 and want.exceptAll(rows).count() == 0


def test_no_keys_read_nothing(spark, layout):
    none = spark.createDataFrame([], "id long")
    assert layout.films_of("genre_film_work", none).count() == 0


def test_a_layout_opens_from_its_files(spark, catalog, tmp_path):
    LY.write_link_layout(catalog, str(tmp_path), "written_links", buckets=8)
    again = LY.open_link_layout(spark, catalog, str(tmp_path), "opened_links", buckets=8)
    assert not LY.layout_exists(spark, "absent_links") and LY.layout_exists(spark, "opened_links")
    assert len(list((tmp_path / "genre_film_work_by_genre_id").glob("*.parquet"))) <= 8
    keys = spark.createDataFrame([(5,)], "id long")
    rows = again.links("genre_film_work", "genre_id", keys)
    assert rows.count() == catalog.genre_film_work.where("genre_id = 5").count() > 0
    assert "out of 8" in plan_of(rows.groupBy("genre_id").count())


@pytest.mark.parametrize("few", [10_000, 0])
def test_a_run_with_a_layout_writes_the_same_documents(spark, catalog, layout, scratch, monkeypatch, few):
    monkeypatch.setattr(LY, "FEW", few)
    changes = spark.createDataFrame([("genre", 4), ("person", 0), ("person", 21), ("film_work", 150), ("film_work", 150),
                                     ("film_work", 9999), ("genre", 19)], "source string, id long")
    plain, by_key = (DocumentSinks(f"{scratch}/{n}") for n in ("plain", "by_key"))
    process_changes(catalog, changes, plain, 0)
    process_changes(catalog.with_(layout=layout), changes, by_key, 0)
    for index in ("movies", "persons", "genres"):
        a, b = (current_view(spark, s.path(index)).drop("batch_id") for s in (plain, by_key))
        assert a.count() > 0
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_only_films_leaves_a_catalog_that_builds_the_same(spark, catalog, layout):
    ids = spark.createDataFrame([(1,), (150,), (199,)], "id long")
    a = D.film_documents(layout.only_films(catalog, ids)).withColumn("text", F.to_json(F.struct("*"))).select("text")
    b = D.film_documents(catalog).where("id in (1, 150, 199)").withColumn("text", F.to_json(F.struct("*"))).select("text")
    assert a.count() == 3 and a.exceptAll(b).count() == 0
