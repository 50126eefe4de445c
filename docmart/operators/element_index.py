"""Element-level postings: which element of which film's list holds a term.

The rows (term, film_id, group, element, pos) come from the entry rows of the
documents.  An element of a list is named by its id: a list holds one entry per
name and an id has one name, so the id says which element it is and no list
has to be collected or numbered.  Every distinct name is analysed once and its
terms are joined to the entries, so a name that a third of all entries share
costs one analysis, and its rows spread as any skewed join key.

A nested condition is about one element: the postings of its terms, and of its
id if one is given, meet on (film, element).  A flat condition is about all names
of a list together: the postings meet on the film.  Question texts go through the
same analyser as the names.  Stored postings are sorted by term, so a lookup
reads the row groups of its terms only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text_index import analysed_tokens

POSTING = ("term", "film_id", "group", "element", "pos")


def element_postings(entries: DataFrame, **analyser) -> DataFrame:
    """Postings of ``documents.film_entries`` rows; names without a term have none."""
    names = entries.select("name").where("name is not null").distinct()
    terms = analysed_tokens(names.withColumn("text", F.col("name")), "name", "text", **analyser)
    return (entries.join(terms, "name")
            .select(F.col("token").alias("term"), "film_id", "group", F.col("ref_id").alias("element"), "pos"))


def write_postings(postings: DataFrame, path: str, files: int) -> None:
    """Store postings by term: files and row groups cover narrow ranges of terms."""
    (postings.repartitionByRange(files, "term", "film_id").sortWithinPartitions("term", "film_id")
     .write.mode("overwrite").parquet(path))


def question_terms(spark, text: str, **analyser) -> list[str]:
    """The distinct terms of a question; as many as the user typed."""
    one = spark.range(1).select("id", F.lit(text).alias("text"))
    return sorted({r["token"] for r in analysed_tokens(one, "id", "text", **analyser).collect()})


def _hits(postings: DataFrame, group: str, terms: list[str]) -> DataFrame:
    return postings.where((F.col("group") == group) & F.col("term").isin(terms))


def _all_or_any(n: int, operator: str) -> Column:
    if operator not in ("and", "or"):
        raise ValueError("operator must be 'and' or 'or'")
    return F.col("held") == n if operator == "and" else F.lit(True)


def nested_films(postings: DataFrame, group: str, text: str | None = None, element=None, operator: str = "and",
                 **analyser) -> DataFrame:
    """(film_id, element): elements of ``group`` whose name holds all (or any) terms of ``text`` and that have the
    id ``element`` if one is given.  A text without terms matches nothing; no condition at all is an error."""
    if text is None and element is None:
        raise ValueError("a nested condition needs a text or an id")
    rows = postings.where(F.col("group") == group)
    if element is not None:
        rows = rows.where(F.col("element") == F.lit(element))
    if text is None:
        return rows.select("film_id", "element").distinct()
    terms = question_terms(postings.sparkSession, text, **analyser)
    return (_hits(rows, group, terms).groupBy("film_id", "element").agg(F.count_distinct("term").alias("held"))
            .where(_all_or_any(len(terms), operator)).select("film_id", "element"))


def flat_films(postings: DataFrame, group: str, text: str, operator: str = "and", **analyser) -> DataFrame:
    """(film_id): films whose names of ``group`` together hold all (or any) terms of ``text``."""
    terms = question_terms(postings.sparkSession, text, **analyser)
    # first the distinct (film, term) pairs: a film with a huge list is combined before it meets in one task
    pairs = _hits(postings, group, terms).select("film_id", "term").distinct()
    return (pairs.groupBy("film_id").agg(F.count(F.lit(1)).alias("held"))
            .where(_all_or_any(len(terms), operator)).select("film_id"))
