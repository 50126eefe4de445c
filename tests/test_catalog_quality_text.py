"""Catalogue paging and search (E19, E23), quality (E20, E21), text (E22)."""

from pyspark.sql import functions as F

from docmart.operators import catalog as K
from docmart.operators import quality as Q
from docmart.operators import text_index as TX
from docmart.schemas import film_document_schema

from .fixtures import film, make_catalog, person, plink


def test_e19_page_edges(spark):
    want = {0: (1, None, None), 1: (1, None, None), 50: (1, None, None), 51: (2, None, 2), 100: (2, None, 2)}
    for n, (total, prev, nxt) in want.items():
        cat = make_catalog(spark, films=[film(f"f{i:03d}") for i in range(n)])
        m = K.catalog_page_meta(cat, 1).collect()[0]
        assert (m["count"], m["total_pages"], m["prev"], m["next"]) == (n, total, prev, nxt)
    cat = make_catalog(spark, films=[film(f"f{i:03d}") for i in range(51)])
    last = K.catalog_page_meta(cat, 2).collect()[0]
    assert (last["prev"], last["next"], last["exists"]) == (1, None, True)
    assert [r["id"] for r in K.catalog_page(cat, 2).collect()] == ["f050"]
    assert K.catalog_page_meta(cat, 3).collect()[0]["exists"] is False


def test_detail_lookup_and_json(spark):
    cat = make_catalog(spark, films=[film("f1", title="Alpha"), film("f2")], persons=[person("p1", "Ann")],
                       plinks=[plink("f1", "p1", "actor")])
    rows = K.catalog_detail(cat, "f1").collect()
    assert len(rows) == 1 and rows[0]["actors"] == ["Ann"] and rows[0]["genres"] == [None]
    assert '"genres":[null]' in rows[0]["body"] and '"title":"Alpha"' in rows[0]["body"]


def test_e23_search_escaping(spark):
    cat = make_catalog(spark, films=[film("f1", title="100% fun"), film("f2", title="1000 fun"),
                                     film("f3", title="a_b"), film("f4", title="axb")])
    assert sorted(r["id"] for r in K.search_films(cat, "100%").collect()) == ["f1"]
    assert sorted(r["id"] for r in K.search_films(cat, "a_b").collect()) == ["f3"]
    # every term must match some field; id is searchable too
    assert sorted(r["id"] for r in K.search_films(cat, "FUN f2").collect()) == ["f2"]


def test_e20_strict_schema(spark):
    schema = film_document_schema()
    ok = spark.createDataFrame([], schema)
    assert Q.unknown_fields(ok, schema) == []
    extra = ok.withColumn("extra", F.lit(1)).withColumn(
        "actors", F.array(F.struct(F.lit("p").alias("id"), F.lit("n").alias("name"), F.lit(1).alias("age"))))
    assert sorted(Q.unknown_fields(extra, schema)) == ["actors.age", "extra"]
    bodies = spark.createDataFrame([('{"k": 1}',), ('{"k": 1, "x": 2}',)], "props string")
    got = [r[0] for r in bodies.select(Q.strict_check(F.col("props"), ["k"])).collect()]
    assert got == [[], ["x"]]


def test_e21_null_role_links_never_collide(spark):
    cat = make_catalog(spark, films=[film("f1")], persons=[person("p1", "Ann")],
                       plinks=[plink("f1", "p1", None, id="a"), plink("f1", "p1", None, id="b"),
                               plink("f1", "p1", "actor", id="c"), plink("f1", "p1", "actor", id="d")])
    d = Q.duplicate_links(cat).collect()
    assert [(r.table_name, r.role, r.n) for r in d] == [("person_film_work", "actor", 2)]


def test_constraint_rules(spark):
    cat = make_catalog(spark, films=[film("f1", rating=101.0), film("f2", type="short"), film("f3"), film("f3")])
    got = {(r.key, r.rule) for r in Q.constraint_violations(cat).collect()}
    assert got == {("f1", "rating between 0 and 100"), ("f2", "type in allowed set"),
                   ("f3", "primary key unique")}


def test_e22_russian_and_english(spark):
    docs = spark.createDataFrame([(1, "Фильм и the Movie's end")], "doc_id long, text string")
    toks = [(r.pos, r.token) for r in TX.analysed_tokens(docs).orderBy("pos").collect()]
    assert toks == [(0, "фильм"), (3, "movie"), (4, "end")]


def test_stem_table_joins_vocabulary(spark):
    docs = spark.createDataFrame([(1, "running runs ran")], "doc_id long, text string")
    stems = spark.createDataFrame([("running", "run"), ("runs", "run")], "term string, stem string")
    toks = [r.token for r in TX.analysed_tokens(docs, english_stems=stems).orderBy("pos").collect()]
    assert toks == ["run", "run", "ran"]


def test_postings(spark):
    docs = spark.createDataFrame([(1, "red fox red"), (2, "red dog")], "doc_id long, text string")
    got = {(r.term, r.doc_id): (r.tf, r.df) for r in TX.term_postings(TX.analysed_tokens(docs)).collect()}
    assert got == {("red", 1): (2, 2), ("fox", 1): (1, 1), ("red", 2): (1, 2), ("dog", 2): (1, 1)}


def test_russian_list_is_sparks(spark):
    from pyspark.ml.feature import StopWordsRemover
    assert list(TX.RUSSIAN_STOP) == list(StopWordsRemover.loadDefaultStopWords("russian"))


def test_nested_vs_flat(spark):
    from docmart.operators import documents as D
    cat = make_catalog(spark, films=[film("f1"), film("f2")],
                       persons=[person("p17", "Ann"), person("p2", "Bob"), person("p27", "Bob")],
                       plinks=[plink("f1", "p17", "actor"), plink("f1", "p2", "actor"),
                               plink("f2", "p27", "actor")])
    docs = D.film_documents(cat)
    # f1 has a "bob" and an id with 7, but not on the same element
    assert [r.id for r in TX.nested_match(docs, "actors", "bob", "7").collect()] == ["f2"]
    assert sorted(r.id for r in TX.flat_names_match(docs, "actors", "bob").collect()) == ["f1", "f2"]


def test_same_person_in_two_arrays(spark):
    from docmart.operators import documents as D
    cat = make_catalog(spark, films=[film("f1"), film("f2")],
                       persons=[person("p1", "Ann"), person("p2", "Bob")],
                       plinks=[plink("f1", "p1", "actor"), plink("f1", "p1", "director"),
                               plink("f2", "p1", "actor"), plink("f2", "p2", "director")])
    got = [tuple(r) for r in TX.same_person_in(D.film_entries(cat), "actors", "directors").collect()]
    assert got == [("f1", "Ann", "p1")]


def test_k7_cascade_drops_orphans(spark):
    cat = make_catalog(spark, films=[film("f1")], persons=[person("p1", "Ann")],
                       plinks=[plink("f1", "p1", "actor"), plink("f1", "p404", "actor"), plink("f404", "p1", "actor")])
    kept = Q.drop_orphans(cat)
    assert [(r.film_work_id, r.person_id) for r in kept.person_film_work.collect()] == [("f1", "p1")]
    assert Q.orphan_links(kept).count() == 0


def test_l2_film_fields_analysed(spark):
    from docmart.operators import documents as D
    cat = make_catalog(spark, films=[film("f1", title="The Fox's Tale")], persons=[person("p1", "Ann Lee")],
                       plinks=[plink("f1", "p1", "actor")])
    got = [(r.field, r.value_index, r.pos, r.token)
           for r in TX.film_field_tokens(D.film_documents(cat)).orderBy("field", "value_index", "pos").collect()]
    assert got == [("actors_names", 0, 0, "ann"), ("actors_names", 0, 1, "lee"),
                   ("title", 0, 1, "fox"), ("title", 0, 2, "tale")]


def test_api_dangling_link_and_null_role(spark):
    cat = make_catalog(spark, films=[film("f1")], persons=[person("p1", "Ann")],
                       plinks=[plink("f1", "p404", "actor"), plink("f1", "p1", "actor"), plink("f1", "p1", None)])
    row = K.api_films(cat).collect()[0]
    # the left join keeps the dangling actor as a NULL name, sorted last; the NULL role is in no list
    assert row["actors"] == ["Ann", None] and row["directors"] == [] and row["writers"] == []


def test_last_page(spark):
    cat = make_catalog(spark, films=[film(f"f{i:03d}") for i in range(120)])
    assert [r.id for r in K.catalog_page(cat, "last").collect()] == [f"f{i:03d}" for i in range(100, 120)]
    m = K.catalog_page_meta(cat, "last").collect()[0]
    assert (m["page"], m["prev"], m["next"], m["total_pages"]) == (3, 2, None, 3)
