"""Pages by an index of ranges, contains search by trigrams, runs that resume."""

import io
import re
from contextlib import redirect_stdout
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docmart.operators import page_index as PI
from docmart.operators import trigram_index as TG
from docmart.functions.search import all_terms_match
from docmart.sources.sinks import ProgressLog, current_view
from docmart.sources.tables import Catalog
from docmart.streaming import incremental as I


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    # a third of all rows share one time
    rows = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id")).alias("at"), F.lit("x").alias("place"))
    extra = spark.createDataFrame([(None, 4, "x"), (5000, None, "x")], "id long, at long, place string")
    return PI.write_page_index(rows.union(extra.select(*rows.columns)), ["at", "id"], str(tmp_path_factory.mktemp("pages")), 8)


@pytest.fixture(scope="module")
def ordered():
    return sorted(((500 if i % 3 == 0 else i), i) for i in range(1000))


@pytest.mark.parametrize("page, size", [(0, 100), (3, 100), (9, 100), (10, 100), (0, 1), (499, 2), (0, 5000), (1, 700)])
def test_pages_have_the_rows_of_their_places(index, ordered, page, size):
    got = [(r["place"], r["at"], r["id"]) for r in index.page(page, size).collect()]
    want = [(n, *ordered[n]) for n in range(page * size, min(len(ordered), (page + 1) * size))]
    assert sorted(got) == want


@pytest.mark.parametrize("mark", [0, 250, 500, 501, 998, 5000])
def test_pages_since_a_mark(index, ordered, mark):
    left = [r for r in ordered if r[0] >= mark]
    assert index.places_before(F.lit(mark)) == len(ordered) - len(left)
    assert index.pages(100, F.lit(mark)) == max(1, -(-len(left) // 100))
    got = sorted((r["at"], r["id"]) for r in index.page(1, 100, F.lit(mark)).collect())
    assert got == left[100:200]


def test_a_page_opens_few_ranges_wherever_it_is(index):
    assert index.count() == 1000
    for page in (0, 5, 9):
        out = io.StringIO()
        with redirect_stdout(out):
            index.page(page, 100).explain("formatted")
        filters = re.search(r"PartitionFilters: \[(.*)\]", out.getvalue())[1]
        assert 1 <= len(re.findall(r"\d+", re.sub(r"range_no#\d+", "", filters))) <= 3


def test_an_index_of_nothing(spark, tmp_path):
    empty = PI.write_page_index(spark.createDataFrame([], "at long, id long"), ["at", "id"], str(tmp_path / "p"), 4)
    assert empty.count() == 0 and empty.pages(10) == 1 and empty.page(0, 10).count() == 0 and empty.places_before(F.lit(3)) == 0


TEXTS = [(1, "Star Wars: A New Hope", None), (2, "star trek", "wars"), (3, "100% Wolf", "a_b"), (4, "Звёздные ВОЙНЫ", "x"), (5, None, None),
         (6, "ab", "Wars Wars"), (7, "1000 wolf", "axb"), (8, "", ""), (9, "back\\slash%", "é" * 4000 + "warp")]


@pytest.mark.parametrize("query", ["wars", "WARS star", "войны", "100%", "a_b", "slash%", "k\\s", "zzz", "st ar", "ab", "x", "", "warp éé",
                                   "wolf 10", "wars zzz"])
def test_trigram_search_equals_the_scan(spark, query):
    df = spark.createDataFrame(TEXTS, "id long, title string, gram string")
    fields = ["title", "gram"]
    postings = TG.trigram_postings(df, fields)
    got = sorted(r["id"] for r in TG.search(df, postings, fields, query).collect())
    assert got == sorted(r["id"] for r in df.where(all_terms_match(fields, query)).collect())


def test_the_rarest_gram_of_each_term_is_asked(spark, tmp_path):
    df = spark.createDataFrame([(i, "aaabbb" if i else "aaabbbccc") for i in range(5)], "id long, title string")
    TG.write_trigrams(TG.trigram_postings(df, ["title"]), str(tmp_path / "t"), 2)
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert TG.rarest_grams(stored, ["bbbcc", "no", "aaab"])[1:] == ["bbc"] or "bbc" in TG.rarest_grams(stored, ["bbbcc", "no", "aaab"])
    assert TG.rarest_grams(stored, ["zz", ""]) == []


def catalog(spark):
    def at(c):
        return f"timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, {c})"
    films = spark.sql(f"select id, concat('t', id) title, cast(null as string) description, date'2020-01-01' creation_date, "
                      f"cast(null as string) certificate, cast(null as string) file_path, 5.0D rating, 'movie' type, "
                      f"{at('id')} created, {at('id')} modified from range(60)")
    person = spark.sql(f"select id, concat('p', id) full_name, {at('id * 4')} created, {at('id * 4')} modified from range(10)")
    genre = spark.sql(f"select id, concat('g', id) name, cast(null as string) description, {at('id * 7')} created, {at('id * 7')} modified from range(5)")
    pfw = spark.sql("select id film_work_id, id % 10 person_id, 'actor' role from range(60)")
    gfw = spark.sql("select id film_work_id, id % 5 genre_id from range(60)")
    return Catalog(films, person, genre, pfw, gfw, pfw, gfw)


def test_a_run_that_dies_goes_on_at_its_slice(spark, scratch, monkeypatch):
    cat, now = catalog(spark), datetime(2024, 1, 2)
    start = datetime(2024, 1, 1)
    whole, sliced = (I.DocumentSinks(f"{scratch}/{n}", {"movies": 2}) for n in ("whole", "sliced"))
    I.run_incremental(spark, lambda: cat, whole, ProgressLog(spark, f"{scratch}/log1"), now, default_start=start)

    seen, process = [], I.process_changes

    def dying(c, changes, sinks, batch_id):
        if len(seen) == 2:
            raise RuntimeError("executor lost")
        seen.append(sorted((r["source"], r["id"]) for r in changes.collect()))
        process(c, changes, sinks, batch_id)

    log = ProgressLog(spark, f"{scratch}/log2")
    monkeypatch.setattr(I, "process_changes", dying)
    with pytest.raises(RuntimeError):
        I.run_incremental(spark, lambda: cat, sliced, log, now, timedelta(0), start, slices=4)
    first = [r for part in seen for r in part]
    mark = log.last_mark("film_work")
    assert start < mark < now and len(seen) == 2

    again = []

    def going_on(c, changes, sinks, batch_id):
        again.extend(sorted((r["source"], r["id"]) for r in changes.collect()))
        process(c, changes, sinks, batch_id)

    monkeypatch.setattr(I, "process_changes", going_on)
    I.run_incremental(spark, lambda: cat, sliced, log, now, timedelta(0), start, slices=4)
    assert not set(first) & set(again) and len(first) + len(again) == 75        # every change once
    assert log.last_mark("genre") == now
    for name in ("movies", "persons", "genres"):
        a, b = (current_view(spark, s.path(name)).drop("batch_id") for s in (whole, sliced))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert current_view(spark, sliced.path("movies")).where("part = 1").count() > 0
