"""Text analysis and postings over documents (the `ru_en` analyser as a Spark job).

Chain: tokenize -> lowercase -> English stop -> English stem -> English
possessive -> Russian stop -> Russian stem.  Everything is a built-in
expression inside whole-stage codegen: the tokenizer is a Unicode regex
(an approximation of the standard word-break tokenizer), stop lists are
``isin`` sets, the possessive rule is a regex.  A stemmer is a column function
(``stemming.english_stem``, ``stemming.russian_stem``) or a table ``(term, stem)``;
either is applied to the *distinct vocabulary*, never to the token stream.  Positions are those of the
token stream before stop removal (removed words leave gaps).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

# Token pattern: runs of letters/digits, inner apostrophes followed by letters kept.
TOKEN_PATTERN = r"[\p{L}\p{N}]+(?:['’]\p{L}+)*"
POSSESSIVE_PATTERN = r"['’]s$"   # applied after lowercasing

# ---- fixed values: the default English stop set of the standard analysers ----
ENGLISH_STOP = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is",
    "it", "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there",
    "these", "they", "this", "to", "was", "will", "with",
)
# ---- fixed values: the Snowball Russian stop list (the one Spark ML ships) ----
RUSSIAN_STOP = tuple("""
    и в во не что он на я с со как а то все она так его но да ты к у же вы за бы по только
    ее мне было вот от меня еще нет о из ему теперь когда даже ну вдруг ли если уже или ни
    быть был него до вас нибудь опять уж вам ведь там потом себя ничего ей может они тут где
    есть надо ней для мы тебя их чем была сам чтоб без будто чего раз тоже себе под будет ж
    тогда кто этот того потому этого какой совсем ним здесь этом один почти мой тем чтобы
    нее сейчас были куда зачем всех никогда можно при наконец два об другой хоть после над
    больше тот через эти нас про всего них какая много разве три эту моя впрочем хорошо свою
    этой перед иногда лучше чуть том нельзя такой им более всегда конечно всю между
""".split())
# -------------------------------------------------------------------------------


def russian_stop_words() -> list[str]:
    return list(RUSSIAN_STOP)


Stems = DataFrame | Callable[[Column], Column] | None


def _stemmed(vocab: DataFrame, stems: Stems) -> DataFrame:
    """The vocabulary with its column ``term`` stemmed."""
    if stems is None:
        return vocab
    if callable(stems):
        return vocab.withColumn("term", stems(F.col("term")))
    known = stems.select("term", F.col("stem").alias("_stem"))
    return vocab.join(known, "term", "left").withColumn("term", F.coalesce("_stem", "term")).drop("_stem")


def _without_possessive(terms: DataFrame, col: str) -> DataFrame:
    """A trailing 's / ’s dropped (plain string ops, no per-token regex)."""
    tok = F.col(col)
    possessive = tok.endswith("'s") | tok.endswith("’s")
    return terms.withColumn(col, F.when(possessive, F.expr(f"substring({col}, 1, char_length({col}) - 2)")).otherwise(tok))


def analysed_tokens(docs: DataFrame, id_col: str | list[str] = "doc_id", text_col: str = "text",
                    english_stop=ENGLISH_STOP, russian_stop=None,
                    english_stems: Stems = None, russian_stems: Stems = None) -> DataFrame:
    """(id..., pos, token) for every analysed token of every document.

    What follows the tokenizer depends on the token alone, so with a stemmer the
    rest of the chain runs once per distinct token and is joined to the stream.
    """
    rus = list(russian_stop) if russian_stop is not None else russian_stop_words()
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    toks = docs.select(*ids, F.posexplode(
        F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(TOKEN_PATTERN), 0)).alias("pos", "token"))
    toks = toks.where(~F.col("token").isin(list(english_stop)))
    if english_stems is None and russian_stems is None:
        toks = _without_possessive(toks, "token")
        return toks.where(~F.col("token").isin(rus) & (F.col("token") != "")).select(*ids, "pos", "token")
    # written, or the filters below, and the stemmers with them, are moved under the distinct to every token
    vocab = materialize(toks.select("token").distinct(), "vocabulary").withColumn("term", F.col("token"))
    vocab = _without_possessive(_stemmed(vocab, english_stems), "term")
    vocab = _stemmed(vocab.where(~F.col("term").isin(rus) & (F.col("term") != "")), russian_stems)
    # one row a word on the right: hashed, the token stream needs no sort
    return toks.join(vocab.hint("shuffle_hash"), "token").select(*ids, "pos", F.col("term").alias("token"))


ANALYSED_FILM_FIELDS = ("title", "description", "actors_names", "writers_names", "directors_names",
                        "genres_names")
ANALYSED_PERSON_FIELDS = ("name",)
ANALYSED_GENRE_FIELDS = ("name", "description")


def film_field_tokens(docs: DataFrame, fields=ANALYSED_FILM_FIELDS, **analyser) -> DataFrame:
    """Analysed tokens of an index's text fields (the film index's unless others are
    given): (id, field, value_index, pos, token).

    Each value of a multi-valued field (a name list) is analysed on its own;
    ``value_index`` is its place in the list, ``pos`` the position inside it.
    """
    def values_of(f):
        if dict(docs.dtypes)[f].startswith("array"):
            return F.transform(f, lambda v, i: F.struct(
                F.lit(f).alias("field"), i.alias("value_index"), v.alias("value")))
        return F.array(F.struct(F.lit(f).alias("field"), F.lit(0).alias("value_index"), F.col(f).alias("value")))

    # one pass over the documents: all fields leave in one explode
    values = docs.select("id", F.inline(F.concat(*[values_of(f) for f in fields])))
    return analysed_tokens(values.where(F.col("value").isNotNull()), ["id", "field", "value_index"],
                           "value", **analyser)


def term_postings(tokens: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(term, doc, tf, df): one row per term and document.

    Postings stay rows (a term in every document would make a single
    collected list unbounded).  They are written once to the shared folder, so
    the corpus is tokenised once.  ``df`` is a partial count joined back on the
    term; AQE's skew join splits the postings of very frequent terms.
    """
    postings = materialize(
        tokens.groupBy(F.col("token").alias("term"), F.col(id_col)).agg(F.count(F.lit(1)).alias("tf"))
        .sortWithinPartitions("term"), "postings")      # equal terms side by side: fewer bytes, here and in the shuffle below
    dfreq = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    # the vocabulary grows with the corpus and the planner's size estimate does
    # not see the explode, so no static broadcast: a sort-merge join, which
    # AQE's skew handling splits for very frequent terms
    return postings.join(dfreq.hint("merge"), "term")


def nested_match(docs: DataFrame, group: str, name_term: str, id_term: str) -> DataFrame:
    """Films where ONE element of ``group`` has a name containing ``name_term`` AND an
    id containing ``id_term`` (nested semantics: both conditions on the same element)."""
    def hit(x):
        return F.lower(x["name"]).contains(name_term.lower()) & x["id"].cast("string").contains(id_term)

    return (docs.where(F.exists(group, hit))
                .select("id", "title", F.filter(group, hit).alias("matched")))


def same_person_in(entries: DataFrame, group: str, other: str) -> DataFrame:
    """Nested match across two arrays, from the entry rows of ``documents.film_entries``:
    (film_id, name, ref_id) of the elements of ``group`` that equal an element of
    ``other`` on id AND name together (e.g. actors who also direct).  Linear: the
    rows of one film, name and id are grouped, no element is compared with another."""
    both = entries.where(F.col("group").isin(group, other)).groupBy("film_id", "name", "ref_id").agg(
        F.max(F.col("group") == group).alias("in_group"), F.max(F.col("group") == other).alias("in_other"))
    return both.where("in_group and in_other").select("film_id", "name", "ref_id")


def flat_names_match(docs: DataFrame, group: str, term: str) -> DataFrame:
    """Flattened `*_names` search: any name containing ``term`` (case-insensitive)."""
    return docs.where(F.exists(f"{group}_names", lambda n: F.lower(n).contains(term.lower())))


def films_of_person(entries: DataFrame, groups=("actors", "writers", "directors")) -> DataFrame:
    """Keyword lookup rows (person id, film id, group), from the entry rows of ``documents.film_entries``."""
    return entries.where(F.col("group").isin(list(groups))).select(F.col("ref_id").alias("person_id"), "film_id", "group")
