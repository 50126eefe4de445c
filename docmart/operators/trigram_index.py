"""Contains search by trigram postings.

Every three neighbouring characters of a lower-cased field are a posting (gram,
id).  A term of three characters or more can only be in a row that holds all
its grams, so the rarest of them, by the number of postings, fetches the
candidate rows; ids of several terms meet by semi joins, and the same ``ilike``
as in a scan decides.  Shorter terms have no gram and only decide among the
candidates of the others; with none left the table is scanned.  Postings are sorted by
gram when they are stored, so a lookup reads the row groups of its grams.  What
comes to the driver is one count for each gram of the question.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.search import all_terms_match, split_terms

GRAM = 3


def _grams(text):
    """Distinct grams of a text column ([] if shorter)."""
    last = F.char_length(text) - GRAM + 1
    return F.when(last >= 1, F.array_distinct(F.transform(
        F.sequence(F.lit(1), last), lambda i: F.substring(text, i, F.lit(GRAM))))).otherwise(F.array().cast("array<string>"))


def trigram_postings(df: DataFrame, fields: list[str], key: str = "id") -> DataFrame:
    """(gram, id) over all fields, each once."""
    grams = F.array_distinct(F.flatten(F.array(*[
        F.coalesce(_grams(F.lower(F.col(f).cast("string"))), F.array().cast("array<string>")) for f in fields])))
    return df.select(F.explode(grams).alias("gram"), F.col(key).alias("id"))


def write_trigrams(postings: DataFrame, path: str, files: int) -> None:
    postings.repartitionByRange(files, "gram", "id").sortWithinPartitions("gram", "id").write.mode("overwrite").parquet(path)


def rarest_grams(postings: DataFrame, terms: list[str]) -> list[str]:
    """The gram with the fewest postings of each term that has grams."""
    by_term = {t: sorted({t.lower()[i:i + GRAM] for i in range(len(t.lower()) - GRAM + 1)}) for t in terms}
    asked = sorted({g for gs in by_term.values() for g in gs})
    if not asked:
        return []
    counts = {r["gram"]: r["n"] for r in postings.where(F.col("gram").isin(asked)).groupBy("gram")
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted({min(gs, key=lambda g: (counts.get(g, 0), g)) for gs in by_term.values() if gs})


def search(df: DataFrame, postings: DataFrame, fields: list[str], query: str, key: str = "id") -> DataFrame:
    """The rows of ``df`` in which every term of ``query`` is in some field."""
    grams = rarest_grams(postings, split_terms(query))
    candidates = [postings.where(F.col("gram") == g).select(F.col("id").alias(key)) for g in grams]
    found = reduce(lambda rows, ids: rows.join(ids, key, "left_semi"), candidates, df)
    return found.where(all_terms_match(fields, query)).select(*df.columns)
