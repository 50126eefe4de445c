"""Property tests: documents equal a plain fold over the fan-out rows, and any
split of the change feed into (replayed) batches gives the full rebuild."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from docmart.operators import documents as D
from docmart.sources import sinks as SK

from .fixtures import film, genre, glink, make_catalog, person, plink

FILMS = [f"f{i}" for i in range(5)]
PEOPLE = [f"p{i}" for i in range(6)]
GENRES = [f"g{i}" for i in range(4)]
ROLES = ["actor", "producer", "director", None]
GROUP_OF = {"actor": "actors", "producer": "writers", "director": "directors"}

catalogs = st.fixed_dictionaries({
    "names": st.lists(st.sampled_from(["Ann", "Bob", ""]), min_size=6, max_size=6),
    "gnames": st.lists(st.sampled_from(["Drama", "Comedy", ""]), min_size=4, max_size=4),
    "plinks": st.sets(st.tuples(st.sampled_from(FILMS), st.sampled_from(PEOPLE + ["p404"]),
                                st.sampled_from(ROLES)), max_size=14),
    "glinks": st.sets(st.tuples(st.sampled_from(FILMS), st.sampled_from(GENRES)), max_size=8),
})

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def build(spark, c):
    return make_catalog(
        spark, films=[film(f) for f in FILMS],
        persons=[person(p, n) for p, n in zip(PEOPLE, c["names"])],
        genres=[genre(g, n) for g, n in zip(GENRES, c["gnames"])],
        plinks=[plink(*x) for x in c["plinks"]], glinks=[glink(*x) for x in c["glinks"]])


def fold(c):
    """The documents by a plain loop over film x person-link x genre-link rows."""
    names = dict(zip(PEOPLE, c["names"]))
    gnames = dict(zip(GENRES, c["gnames"]))
    out = {}
    for f in FILMS:
        doc = {g: {} for g in ("actors", "writers", "directors", "genres")}
        plinks = [x for x in c["plinks"] if x[0] == f] or [None]
        glinks = [x for x in c["glinks"] if x[0] == f] or [None]
        for pl in plinks:
            for gl in glinks:
                if pl and pl[2] in GROUP_OF and pl[1] in names:
                    grp, n = doc[GROUP_OF[pl[2]]], names[pl[1]]
                    grp[n] = min(grp.get(n, pl[1]), pl[1])
                if gl and gnames[gl[1]]:
                    grp, n = doc["genres"], gnames[gl[1]]
                    grp[n] = min(grp.get(n, gl[1]), gl[1])
        out[f] = {g: sorted((i, n) for n, i in d.items()) for g, d in doc.items()}
    return out


def as_docs(df):
    return {r["id"]: {g: sorted((x["id"], x["name"]) for x in r[g])
                      for g in ("actors", "writers", "directors", "genres")}
            for r in df.collect()}


@SETTINGS
@given(c=catalogs)
def test_documents_equal_fold(spark, c):
    assert as_docs(D.film_documents(build(spark, c))) == fold(c)


@SETTINGS
@given(c=catalogs, batches=st.lists(st.lists(st.sampled_from(FILMS), min_size=1, max_size=5), min_size=1, max_size=3),
       replay=st.booleans())
def test_incremental_equals_full(spark, c, batches, replay):
    import tempfile

    cat = build(spark, c)
    path = tempfile.mkdtemp(prefix="docmart-prop-") + "/movies"
    batches = batches + [FILMS]                    # the last batch touches every film
    for b, ids in enumerate(batches, start=1):
        keys = spark.createDataFrame([(i,) for i in sorted(set(ids))], "id string")
        SK.upsert(D.film_documents(cat, keys), path, b)
        if replay:
            SK.upsert(D.film_documents(cat, keys), path, b)
    current = SK.current_view(spark, path).drop("batch_id")
    assert as_docs(current) == as_docs(D.film_documents(cat))
    assert current.count() == len(FILMS)
