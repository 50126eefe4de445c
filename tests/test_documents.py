"""Document builder edge cases (FIXTURES.md section 3: E1-E13)."""

from docmart.operators import documents as D
from docmart.operators import catalog as K
from docmart.operators import quality as Q

from .fixtures import film, genre, glink, make_catalog, person, plink, rows_by_id


def refs(xs):
    return [(x["id"], x["name"]) for x in xs]


def test_e1_same_genre_name_two_ids(spark):
    cat = make_catalog(spark, films=[film("f1")], genres=[genre("g2", "Drama"), genre("g1", "Drama")],
                       glinks=[glink("f1", "g1"), glink("f1", "g2")])
    d = rows_by_id(D.film_documents(cat))["f1"]
    assert refs(d["genres"]) == [("g1", "Drama")]
    assert d["genres_names"] == ["Drama"]


def test_e2_same_person_name_same_role(spark):
    cat = make_catalog(spark, films=[film("f1")], persons=[person("p2", "Ann"), person("p1", "Ann")],
                       plinks=[plink("f1", "p1", "actor"), plink("f1", "p2", "actor")])
    d = rows_by_id(D.film_documents(cat))["f1"]
    assert refs(d["actors"]) == [("p1", "Ann")]
    assert d["actors_names"] == ["Ann"]


def test_e3_one_person_two_roles(spark):
    cat = make_catalog(spark, films=[film("f1")], persons=[person("p1", "Ann")],
                       plinks=[plink("f1", "p1", "actor"), plink("f1", "p1", "director")])
    d = rows_by_id(D.film_documents(cat))["f1"]
    assert refs(d["actors"]) == [("p1", "Ann")] and refs(d["directors"]) == [("p1", "Ann")]
    p = rows_by_id(D.person_documents(cat))["p1"]
    assert p["role"] == ["actor", "director"] and p["film_ids"] == ["f1"]


def test_e4_producer_is_writer(spark):
    cat = make_catalog(spark, films=[film("f1")], persons=[person("p1", "Ann")],
                       plinks=[plink("f1", "p1", "producer")])
    d = rows_by_id(D.film_documents(cat))["f1"]
    assert refs(d["writers"]) == [("p1", "Ann")] and d["writers_names"] == ["Ann"]
    assert d["actors"] == [] and d["directors"] == []


def test_e5_person_without_links(spark):
    cat = make_catalog(spark, persons=[person("p9", "Solo")])
    p = rows_by_id(D.person_documents(cat))["p9"]
    assert p["role"] == [None] and p["film_ids"] == [None]


def test_e6_genre_without_links(spark):
    cat = make_catalog(spark, genres=[genre("g9", "Lonely")])
    assert D.genre_documents(cat).count() == 0


def test_e7_film_without_links(spark):
    cat = make_catalog(spark, films=[film("f9")])
    d = rows_by_id(D.film_documents(cat))["f9"]
    for g in ("actors", "writers", "directors", "genres"):
        assert d[g] == [] and d[f"{g}_names"] == []
    a = rows_by_id(K.api_films(cat))["f9"]
    assert a["genres"] == [None]
    assert a["actors"] == [] and a["directors"] == [] and a["writers"] == []


def test_e8_null_role(spark):
    cat = make_catalog(spark, films=[film("f1")], persons=[person("p1", "Ann")],
                       plinks=[plink("f1", "p1", None)])
    d = rows_by_id(D.film_documents(cat))["f1"]
    assert d["actors"] == [] and d["writers"] == [] and d["directors"] == []
    p = rows_by_id(D.person_documents(cat))["p1"]
    assert p["role"] == [None] and p["film_ids"] == ["f1"]


def test_e9_null_type_or_created_rejected(spark):
    cat = make_catalog(spark, films=[film("f1"), film("f2", type=None), film("f3", created=None)])
    assert set(rows_by_id(D.film_documents(cat))) == {"f1"}
    rej = rows_by_id(Q.rejected_films(cat.film_work))
    assert rej["f2"]["reasons"] == ["type is null"] and rej["f3"]["reasons"] == ["created is null"]


def test_e10_null_rating_stays_null(spark):
    cat = make_catalog(spark, films=[film("f3", rating=None)])
    assert rows_by_id(D.film_documents(cat))["f3"]["imdb_rating"] is None


def test_e11_empty_names(spark):
    cat = make_catalog(spark, films=[film("f1")], persons=[person("p1", "")], genres=[genre("g1", "")],
                       plinks=[plink("f1", "p1", "actor")], glinks=[glink("f1", "g1")])
    d = rows_by_id(D.film_documents(cat))["f1"]
    assert d["genres"] == [] and refs(d["actors"]) == [("p1", "")]


def test_e12_dangling_person_link(spark):
    cat = make_catalog(spark, films=[film("f1")], persons=[person("p1", "Ann")],
                       plinks=[plink("f1", "p404", "actor"), plink("f1", "p1", "actor")])
    d = rows_by_id(D.film_documents(cat))["f1"]
    assert refs(d["actors"]) == [("p1", "Ann")]
    o = Q.orphan_links(cat).collect()
    assert [(r.table_name, r.other_id, r.missing) for r in o] == [("person_film_work", "p404", "person")]


def test_e13_many_by_many(spark):
    ps = [person(f"p{i}", f"N{i}") for i in range(3)]
    gs = [genre(f"g{i}", f"G{i}") for i in range(3)]
    cat = make_catalog(spark, films=[film("f1")], persons=ps, genres=gs,
                       plinks=[plink("f1", f"p{i}", "actor") for i in range(3)],
                       glinks=[glink("f1", f"g{i}") for i in range(3)])
    d = rows_by_id(D.film_documents(cat))["f1"]
    assert d["actors_names"] == ["N0", "N1", "N2"] and d["genres_names"] == ["G0", "G1", "G2"]
    # linear link rows: 3 + 3, never the 9-row product
    assert D.film_link_rows(cat).count() == 6


def test_documents_equal_python_fold(spark):
    """Pre-aggregated documents equal a plain fold over the fan-out rows."""
    import random

    rnd = random.Random(7)
    films = [film(f"f{i}") for i in range(12)]
    ps = [person(f"p{i}", f"N{i % 5}") for i in range(15)]
    gs = [genre(f"g{i}", f"G{i % 4}") for i in range(9)]
    pl = {(f"f{rnd.randrange(12)}", f"p{rnd.randrange(15)}", rnd.choice(["actor", "producer", "director", None]))
          for _ in range(60)}
    gl = {(f"f{rnd.randrange(12)}", f"g{rnd.randrange(9)}") for _ in range(30)}
    cat = make_catalog(spark, films=films, persons=ps, genres=gs,
                       plinks=[plink(*x) for x in pl], glinks=[glink(*x) for x in gl])
    got = rows_by_id(D.film_documents(cat))
    names = {p[0]: p[1] for p in ps}
    gnames = {g[0]: g[1] for g in gs}
    for f in (x[0] for x in films):
        exp = {}
        for group, role in (("actors", "actor"), ("writers", "producer"), ("directors", "director")):
            best = {}
            for (ff, pid, r) in pl:
                if ff == f and r == role:
                    n = names[pid]
                    best[n] = min(best.get(n, pid), pid)
            exp[group] = sorted((pid, n) for n, pid in best.items())
        best = {}
        for (ff, gid) in gl:
            if ff == f:
                best[gnames[gid]] = min(best.get(gnames[gid], gid), gid)
        exp["genres"] = sorted((gid, n) for n, gid in best.items())
        for group, want in exp.items():
            assert sorted(refs(got[f][group])) == want, (f, group)
            assert got[f][f"{group}_names"] == sorted(n for _, n in want)
