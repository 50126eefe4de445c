"""Stemmers against known pairs, the analyser with them, and element-level postings."""

import pytest
from pyspark.sql import functions as F

from docmart.operators import element_index as EI
from docmart.operators import stemming as ST
from docmart.operators.text_index import analysed_tokens

# pairs of the published rules and sample lists
ENGLISH = """
caresses caress, ponies poni, ties ti, caress caress, cats cat, feed feed, agreed agre, plastered plaster, bled bled,
motoring motor, sing sing, conflated conflat, troubled troubl, sized size, hopping hop, tanned tan, falling fall,
hissing hiss, fizzed fizz, failing fail, filing file, happy happi, sky sky, relational relat, conditional condit,
rational ration, valenci valenc, hesitanci hesit, digitizer digit, conformabli conform, radicalli radic,
differentli differ, vileli vile, analogousli analog, vietnamization vietnam, predication predic, operator oper,
feudalism feudal, decisiveness decis, hopefulness hope, callousness callous, formaliti formal, sensitiviti sensit,
sensibiliti sensibl, triplicate triplic, formative form, formalize formal, electriciti electr, electrical electr,
hopeful hope, goodness good, revival reviv, allowance allow, inference infer, airliner airlin, gyroscopic gyroscop,
adjustable adjust, defensible defens, irritant irrit, replacement replac, adjustment adjust, dependent depend,
adoption adopt, homologou homolog, communism commun, activate activ, angulariti angular, homologous homolog,
effective effect, bowdlerize bowdler, probate probat, rate rate, cease ceas, controll control, roll roll, as as,
played plai, say sai, generalizations gener, oscillators oscil, running run, y y, yes ye, syzygy syzygi,
enjoying enjoi, dying dy, über über, фильм фильм
"""
RUSSIAN = """
в в, вавиловка вавиловк, важная важн, важнее важн, важнейшие важн, важнейшими важн, важничал важнича, важно важн,
важного важн, важный важн, вдруг вдруг, вечер вечер, вечера вечер, вечерам вечер, вечность вечност, взаимность взаимност,
книгами книг, читал чита, читавший чита, сделавшись сдела, умывшись ум, бегающий бега, радостью радост,
красивейший красив, длинный длин, ёлками елк, п п, поцеловать поцелова, поцелуем поцелу, падал пада, падая пад,
печальная печальн, встр встр, movie movie
"""


def pairs(text):
    return [tuple(p.split()) for p in text.replace("\n", " ").split(",")]


@pytest.mark.parametrize("stem, text", [(ST.english_stem, ENGLISH), (ST.russian_stem, RUSSIAN)])
def test_known_stems(spark, stem, text):
    rows = pairs(text)
    df = spark.createDataFrame(rows, "term string, want string").repartition(2).withColumn("stem", stem(F.col("term")))
    assert {r["term"]: r["stem"] for r in df.collect()} == dict(rows)
    # a filter on the stem moves into the scan as one expression
    assert df.where("stem <=> want").count() == len(rows)


@pytest.mark.parametrize("stem", [ST.english_stem, ST.russian_stem])
def test_stems_of_null_empty_and_long_terms(spark, stem):
    long = "a" * 30000 + "ing"
    df = spark.createDataFrame([(None,), ("",), (long,)], "term string").withColumn("stem", stem(F.col("term")))
    got = {r["term"]: r["stem"] for r in df.collect()}
    assert got[None] is None and got[""] == "" and len(got[long]) >= 30000


def test_analyser_chain_with_both_stemmers(spark):
    docs = spark.createDataFrame([(1, "The players' running games"), (2, "Он читал книгами of the runner's films")],
                                 "doc_id long, text string")
    tokens = analysed_tokens(docs, english_stems=ST.english_stem, russian_stems=ST.russian_stem)
    got = sorted((r["doc_id"], r["pos"], r["token"]) for r in tokens.collect())
    # the English stemmer stands before the possessive filter, so it takes the s of 's alone
    assert got == [(1, 1, "player"), (1, 2, "run"), (1, 3, "game"), (2, 1, "чита"), (2, 2, "книг"), (2, 5, "runner'"), (2, 6, "film")]


ENTRIES = [(1, "actors", "Ann Lee", 10), (1, "actors", "Bob Ray", 11), (1, "directors", "Ann Ray", 12),
           (2, "actors", "Ann Ray", 12), (2, "actors", "Cy", 13), (3, "actors", "Lee Ann Ann", 14), (4, "actors", "", 15),
           (5, "actors", None, 16), (6, "actors", "The", 17)]


@pytest.fixture(scope="module")
def postings(spark):
    return EI.element_postings(spark.createDataFrame(ENTRIES, "film_id long, group string, name string, ref_id long"))


def films(df):
    return sorted(r["film_id"] for r in df.select("film_id").distinct().collect())


def test_postings_are_the_terms_of_every_element(postings):
    got = sorted((r["film_id"], r["group"], r["element"], r["pos"], r["term"]) for r in postings.collect())
    assert (3, "actors", 14, 2, "ann") in got and (1, "directors", 12, 1, "ray") in got
    assert [g for g in got if g[0] in (4, 5, 6)] == []        # empty, null and stop-word names hold no term
    assert len(got) == 12


def test_a_nested_condition_is_about_one_element_and_a_flat_one_about_the_list(postings):
    assert films(EI.nested_films(postings, "actors", "ann RAY")) == [2]
    assert films(EI.flat_films(postings, "actors", "ann RAY")) == [1, 2]
    assert films(EI.nested_films(postings, "actors", "ann ray", operator="or")) == [1, 2, 3]
    assert films(EI.flat_films(postings, "actors", "cy lee", operator="or")) == [1, 2, 3]
    assert films(EI.nested_films(postings, "directors", "ann ray")) == [1]


def test_name_and_id_must_hold_for_the_same_element(postings):
    assert films(EI.nested_films(postings, "actors", "ann", 10)) == [1]
    assert films(EI.nested_films(postings, "actors", "ann", 11)) == []
    assert films(EI.nested_films(postings, "actors", element=13)) == [2]


def test_texts_without_terms_match_nothing(postings):
    assert films(EI.nested_films(postings, "actors", "the")) == [] and films(EI.flat_films(postings, "actors", "")) == []
    with pytest.raises(ValueError):
        EI.nested_films(postings, "actors")
    with pytest.raises(ValueError):
        EI.flat_films(postings, "actors", "ann", operator="not")


def test_stemmed_names_are_found_by_other_forms(spark):
    rows = spark.createDataFrame([(1, "genres", "Running games", 1)], "film_id long, group string, name string, ref_id long")
    stems = {"english_stems": ST.english_stem, "russian_stems": ST.russian_stem}
    assert films(EI.nested_films(EI.element_postings(rows, **stems), "genres", "run game", **stems)) == [1]


def test_stored_postings_are_cut_by_term(spark, postings, tmp_path):
    EI.write_postings(postings, str(tmp_path / "p"), files=3)
    stored = spark.read.parquet(str(tmp_path / "p"))
    assert stored.count() == postings.count()
    assert films(EI.nested_films(stored, "actors", "ann ray")) == [2]
