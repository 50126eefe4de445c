"""Change detection, fan-out and idempotent upserts (E14-E18)."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from docmart.operators import changes as C
from docmart.operators import documents as D
from docmart.sources import sinks as SK
from docmart.streaming.incremental import DocumentSinks, change_rows, process_changes, run_incremental

from .fixtures import T0, film, genre, glink, make_catalog, person, plink, rows_by_id


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_e14_mark_is_inclusive(spark):
    just_below = T0 - timedelta(microseconds=1)
    cat = make_catalog(spark, films=[film("a", modified=T0), film("b", modified=just_below),
                                     film("c", modified=None)])
    assert ids(C.changed_ids(cat.film_work, "2021-07-01 12:00:00")) == ["a"]


def test_e15_default_start(spark):
    cat = make_catalog(spark, films=[film("old", modified=datetime(2021, 6, 12, 23, 59, 59)),
                                     film("new", modified=datetime(2021, 6, 13))])
    assert ids(C.changed_ids(cat.film_work)) == ["new"]


def test_page_order_and_ties(spark):
    films = [film(f"f{i:02d}", modified=T0 + timedelta(seconds=i // 3)) for i in range(10)]
    cat = make_catalog(spark, films=films)
    pages = [ids(C.changed_ids_page(cat.film_work, page=p, size=4)) for p in range(3)]
    flat = [i for p in pages for i in p]
    assert sorted(flat) == sorted(f[0] for f in films) and len(flat) == 10


def _catalog(spark, g1_mod=T0, p1_mod=T0, f1_mod=T0):
    return make_catalog(
        spark,
        films=[film("f1", modified=f1_mod), film("f2")],
        persons=[person("p1", "Ann", modified=p1_mod), person("p2", "Bob")],
        genres=[genre("g1", "Drama", modified=g1_mod), genre("g2", "Comedy")],
        plinks=[plink("f1", "p1", "actor"), plink("f2", "p2", "director")],
        glinks=[glink("f1", "g1"), glink("f2", "g2")])


def test_e16_changed_genre_rebuilds_film_and_genre(spark, scratch):
    later = T0 + timedelta(days=1)
    cat = _catalog(spark, g1_mod=later)
    changes = change_rows(cat, {t: ("2021-07-01 13:00:00", None) for t in ("genre", "person", "film_work")})
    sinks = DocumentSinks(scratch)
    process_changes(cat, changes, sinks, 1)
    assert ids(spark.read.parquet(sinks.path("movies"))) == ["f1"]
    assert ids(spark.read.parquet(sinks.path("genres"))) == ["g1"]


def test_e17_two_routes_one_rebuild(spark, scratch):
    later = T0 + timedelta(days=1)
    cat = _catalog(spark, g1_mod=later, p1_mod=later)
    routes = C.changed_film_ids(cat, genre_window=("2021-07-01 13:00:00", None),
                                person_window=("2021-07-01 13:00:00", None),
                                film_window=("2021-07-01 13:00:00", None))
    assert ids(routes) == ["f1"]
    sinks = DocumentSinks(scratch)
    changes = change_rows(cat, {t: ("2021-07-01 13:00:00", None) for t in ("genre", "person", "film_work")})
    process_changes(cat, changes, sinks, 1)
    written = spark.read.parquet(sinks.path("movies"))
    assert written.count() == 1
    full = rows_by_id(D.film_documents(cat))["f1"]
    got = rows_by_id(written.drop("batch_id"))["f1"]
    assert got == full


def test_e18_batch_replay_is_idempotent(spark, scratch):
    cat = _catalog(spark)
    docs = D.film_documents(cat)
    path = f"{scratch}/movies"
    SK.upsert(docs, path, 5)
    first = sorted(map(str, spark.read.parquet(path).collect()))
    SK.upsert(docs, path, 5)
    assert sorted(map(str, spark.read.parquet(path).collect())) == first


def test_incremental_equals_full(spark, scratch):
    """Any split of the change feed into batches gives the full rebuild."""
    cat = _catalog(spark)
    path = f"{scratch}/movies"
    for b, part in enumerate([["f2"], ["f1"], ["f1", "f2"]], start=1):
        keys = spark.createDataFrame([(k,) for k in part], "id string")
        SK.upsert(D.film_documents(cat, keys), path, b)
    current = rows_by_id(SK.current_view(spark, path).drop("batch_id"))
    assert current == rows_by_id(D.film_documents(cat))


def test_latest_version_wins(spark, scratch):
    path = f"{scratch}/persons"
    a = spark.createDataFrame([("p1", "old")], "id string, name string")
    b = spark.createDataFrame([("p1", "new")], "id string, name string")
    SK.upsert(a, path, 1)
    SK.upsert(b, path, 2)
    assert [r["name"] for r in SK.current_view(spark, path).collect()] == ["new"]
    out = f"{scratch}/compacted"
    SK.compact(spark, path, out)
    assert [r["name"] for r in spark.read.parquet(out).collect()] == ["new"]


def test_run_incremental_marks(spark, scratch):
    later = T0 + timedelta(days=1)
    state = {"cat": _catalog(spark)}
    sinks = DocumentSinks(f"{scratch}/idx")
    progress = SK.ProgressLog(spark, f"{scratch}/progress")
    now1 = datetime(2021, 7, 1, 13, 0, 0)
    b1 = run_incremental(spark, lambda: state["cat"], sinks, progress, now1)
    assert b1 == 1 and ids(spark.read.parquet(sinks.path("movies"))) == ["f1", "f2"]
    assert progress.last_mark("film_work") == now1
    # genre g1 changes after the first run: only f1 (and g1) are rebuilt
    state["cat"] = _catalog(spark, g1_mod=later)
    b2 = run_incremental(spark, lambda: state["cat"], sinks, progress, later + timedelta(hours=1))
    movies = spark.read.parquet(sinks.path("movies"))
    assert ids(movies.where(F.col("batch_id") == b2)) == ["f1"]
    assert ids(spark.read.parquet(sinks.path("genres")).where(F.col("batch_id") == b2)) == ["g1"]


def test_bulk_actions_keep_nulls(spark, scratch):
    docs = spark.createDataFrame([("g1", "Drama", None)], "id string, name string, description string")
    row = SK.bulk_actions(docs, "genres").collect()[0]
    assert row["_index"] == "genres" and row["_id"] == "g1"
    assert row["_source"] == '{"id":"g1","name":"Drama","description":null}'
    SK.write_bulk_ndjson(SK.bulk_actions(docs, "genres"), f"{scratch}/bulk")
    lines = [r.value for r in spark.read.text(f"{scratch}/bulk").collect()]
    assert lines == ['{"index":{"_index":"genres","_id":"g1"}}', '{"id":"g1","name":"Drama","description":null}']


def test_ensure_table(spark, scratch):
    from docmart.schemas import genre_document_schema
    path = f"{scratch}/genres"
    SK.ensure_table(spark, path, genre_document_schema())
    assert spark.read.parquet(path).count() == 0
    SK.ensure_table(spark, path, genre_document_schema())


def test_h1_mark_is_whole_seconds(spark):
    mark = C.current_mark(spark)
    assert mark.microsecond == 0


def test_h5_ingest_defaults(spark):
    from docmart.sources.tables import with_ingest_defaults
    existing = make_catalog(spark, genres=[genre("g1", "Drama")]).genre
    rows = make_catalog(spark, genres=[genre("g1", "Drama2"), genre(None, "New")]).genre \
        .withColumn("created", F.lit(None).cast("timestamp"))
    out = {r["name"]: r for r in with_ingest_defaults(rows, existing).collect()}
    assert out["Drama2"]["created"] == T0 and out["Drama2"]["modified"] > T0
    assert out["New"]["id"] and len(out["New"]["id"]) == 36 and out["New"]["created"] is not None


def test_jdbc_ranges_cover_every_key_once(spark):
    import uuid

    from docmart.sources.tables import uuid_ranges
    ids = [str(uuid.UUID(int=i * (2 ** 128 - 1) // 40)) for i in range(41)] + [None]
    keys = spark.createDataFrame([(i,) for i in ids], "id string")
    for n in (1, 2, 5, 64):
        times = " + ".join(f"CAST(coalesce({p}, false) AS INT)" for p in uuid_ranges("id", n))
        assert len(uuid_ranges("id", n)) == n and [r[0] for r in keys.selectExpr(times).collect()] == [1] * 42
    # bounds are plain uuids, so the key's own index serves them
    assert uuid_ranges("id", 4)[1] == ("id >= '40000000-0000-0000-0000-000000000000' "
                                       "AND id < '80000000-0000-0000-0000-000000000000'")


def test_full_then_incremental_jobs(spark, scratch):
    from docmart.streaming.jobs import full_rebuild
    state = {"cat": _catalog(spark)}
    sinks = DocumentSinks(f"{scratch}/idx")
    progress = SK.ProgressLog(spark, f"{scratch}/progress")
    b1 = full_rebuild(spark, lambda: state["cat"], sinks, progress)
    assert b1 == 1 and ids(SK.current_view(spark, sinks.path("movies"))) == ["f1", "f2"]
    assert ids(SK.current_view(spark, sinks.path("persons"))) == ["p1", "p2"]
    assert progress.next_batch_id() == 2 and progress.last_mark("genre") is not None


def test_documents_fit_declared_schemas(spark, scratch):
    from docmart.operators.quality import unknown_fields
    from docmart.schemas import film_document_schema, genre_document_schema, person_document_schema
    cat = _catalog(spark)
    for docs, schema in ((D.film_documents(cat), film_document_schema()),
                         (D.person_documents(cat), person_document_schema()),
                         (D.genre_documents(cat), genre_document_schema())):
        assert unknown_fields(docs, schema) == []
        assert [f.name for f in docs.schema.fields] == [f.name for f in schema.fields]
    sinks = DocumentSinks(f"{scratch}/idx")
    sinks.ensure(spark)
    assert spark.read.parquet(sinks.path("movies")).count() == 0


def test_change_scan_layout(spark, scratch):
    import glob

    import pyarrow.parquet as pq

    from docmart.sources.tables import write_for_change_scans
    films = [film(f"f{i:03d}", modified=T0 + timedelta(days=i)) for i in range(60)]
    write_for_change_scans(make_catalog(spark, films=films).film_work, f"{scratch}/fw", files=4)
    ranges = []
    for f in sorted(glob.glob(f"{scratch}/fw/*.parquet")):
        col = pq.read_table(f, columns=["modified"]).column(0).to_pylist()
        ranges.append((min(col), max(col)))
    ranges.sort()
    # files cover disjoint, ordered ranges of `modified`
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:])) and len(ranges) > 1
    got = C.changed_ids(spark.read.parquet(f"{scratch}/fw"), "2021-08-01 00:00:00", "2021-08-05 00:00:00")
    assert got.count() == 4


def test_a1_load_catalog_from_tables(spark, scratch):
    from docmart.sources.tables import ENTITY_TABLES, load_catalog
    cat = _catalog(spark)
    for t in ENTITY_TABLES:
        getattr(cat, t).write.parquet(f"{scratch}/tables/{t}")
    loaded = load_catalog(spark, f"{scratch}/tables")
    assert rows_by_id(D.film_documents(loaded)) == rows_by_id(D.film_documents(cat))


def test_i8_lookback_rereads_late_rows(spark, scratch):
    sinks = DocumentSinks(f"{scratch}/idx")
    progress = SK.ProgressLog(spark, f"{scratch}/progress")
    mark = datetime(2021, 7, 2)
    progress.commit("film_work", datetime(2021, 6, 13), mark, 1)
    progress.commit("person", datetime(2021, 6, 13), mark, 1)
    progress.commit("genre", datetime(2021, 6, 13), mark, 1)
    # f1 was stamped half a second before the mark but committed after the last run
    late = mark - timedelta(milliseconds=500)
    cat = _catalog(spark, f1_mod=late)
    b = run_incremental(spark, lambda: cat, sinks, progress, now=mark + timedelta(hours=1))
    assert ids(spark.read.parquet(sinks.path("movies")).where(F.col("batch_id") == b)) == ["f1"]


def test_i8_each_row_of_the_lookback_is_done_once(spark, scratch):
    sinks, progress = DocumentSinks(f"{scratch}/idx"), SK.ProgressLog(spark, f"{scratch}/progress")
    start, mark, back = datetime(2021, 7, 1), datetime(2021, 7, 2), timedelta(minutes=1)

    def run(cat, now):
        b = run_incremental(spark, lambda: cat, sinks, progress, now, back, start)
        return ids(spark.read.parquet(sinks.path("movies")).where(F.col("batch_id") == b))

    cat = _catalog(spark, f1_mod=mark - timedelta(seconds=30))
    assert "f1" in run(cat, mark)
    assert run(cat, mark + timedelta(seconds=10)) == []                  # read again, done already
    moved = _catalog(spark, f1_mod=mark - timedelta(seconds=20))         # committed late, an older mark than the last run's
    assert run(moved, mark + timedelta(seconds=20)) == ["f1"]
    assert run(moved, mark + timedelta(seconds=30)) == []                # remembered through runs without changes
    assert run(moved, mark + timedelta(hours=1)) == []


def test_mark_is_in_the_session_zone(spark):
    from datetime import datetime, timezone

    from docmart.operators.changes import current_mark

    now = datetime.now(timezone.utc).replace(tzinfo=None)       # the session is in UTC
    assert abs((current_mark(spark) - now).total_seconds()) < 120


def test_unreadable_progress_log_raises(spark, scratch):
    import os

    import pytest

    from docmart.sources.sinks import ProgressLog, ensure_table, read_if_there

    assert read_if_there(spark, f"{scratch}/none") is None
    assert ProgressLog(spark, f"{scratch}/none").next_batch_id() == 1
    os.makedirs(f"{scratch}/broken/batch_id=0")
    with open(f"{scratch}/broken/batch_id=0/part-0.parquet", "w") as f:
        f.write("not parquet")
    schema = spark.range(1).schema
    for call in (lambda: ProgressLog(spark, f"{scratch}/broken").next_batch_id(),
                 lambda: ensure_table(spark, f"{scratch}/broken", schema)):
        with pytest.raises(Exception):
            call()
    assert os.listdir(f"{scratch}/broken") == ["batch_id=0"]
