"""Filter interaction audit: what each filter removes under every order of the filters.

Documents are reduced to failure patterns (one bit a filter), counted per
part.  A pattern is a row of the mask matrix: 0 where the filter fails the
document, infinite where it passes.  An order is a column of the position
matrix: the place of each filter in that order, that is the inverse of the
permutation.  Their min-plus product is the step at which a pattern leaves an
order.  That step scatters the pattern's counts, weighted by documents, good
and toxic ones, into the (order, step) cells; a filter's failures with an
earlier step are its redundant ones.

The product has 32 rows whatever the corpus; Spark does the rest: one scan
that reads each whole text once, texts named by their sha256, small shuffles
(by document for the labels, by text for repeats), and a table of at
most 128 counts a part, which tasks expand to 600 rows a part.

A null text is empty; a null source is the part "".  A null doc_id has no
smaller one and is smaller than none, so its row is never a repeat and makes
none; rows that repeat a doc_id and its text are not repeats of each other.
Labels of one document on several rows count as set if any row sets them.  An
empty table gives no rows; a missing label counts as 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import _AZ, words

FILTERS = "ABCDE"
REPEAT = 1 << FILTERS.index("E")
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, SYMBOLS = 200, 50, 2, r"[#$%&*|]"

SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


def text_failures(text: Column) -> Column:
    """Bits of the filters that look at the text alone (A to D)."""
    w = words(text)
    size, length = F.size(w), F.char_length(text)
    capitals = length - F.char_length(F.translate(text, _AZ, ""))
    fails = (size < MIN_WORDS, 100 * F.size(F.array_distinct(w)) < DISTINCT_PERCENT * size,
             100 * capitals > CAPITAL_PERCENT * length, text.rlike(SYMBOLS))
    return sum((F.when(bad, 1 << i).otherwise(0) for i, bad in enumerate(fails)), F.lit(0))


def failure_patterns(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, pattern, good, toxic, n): documents by the filters that they fail."""
    text = F.coalesce("text", F.lit(""))
    seen = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.sha2(text, 256).alias("same"),
                       text_failures(text).alias("pattern"))
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    kind = ["part", "same", "pattern", "good", "toxic"]
    rows = seen.join(known, "doc_id", "left").fillna(False, ["good", "toxic"]) \
        .groupBy("doc_id", *kind).agg(F.count(F.lit(1)).alias("n"))
    # a text held by a third of all rows leaves each map task as one row a kind
    texts = rows.groupBy(*kind).agg(
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"), F.sum("n").alias("n"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"))
    # a text has at most four rows a part here, whatever the number of its copies
    texts = texts.withColumn("smallest", F.min("first.doc_id").over(Window.partitionBy("same")))
    own = F.col("unnamed") + F.when(F.col("first.doc_id") == F.col("smallest"), F.col("first.n")).otherwise(0)
    split = F.array(F.struct(F.col("pattern"), own.alias("n")),
                    F.struct(F.col("pattern").bitwiseOR(REPEAT).alias("pattern"), (F.col("n") - own).alias("n")))
    return (texts.select("part", "good", "toxic", F.inline(split)).where("n > 0")
            .groupBy("part", "pattern", "good", "toxic").agg(F.sum("n").alias("n")))


def removal_steps() -> tuple[list[str], np.ndarray, np.ndarray]:
    """(orders, position[filter, order], step[pattern, order]); steps count from 1, infinite: never removed."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    position = np.array([[o.index(f) + 1.0 for o in orders] for f in FILTERS])
    bits = np.arange(1 << len(FILTERS))[:, None] >> np.arange(len(FILTERS)) & 1
    mask = np.where(bits == 1, 0.0, np.inf)
    return orders, position, (mask[:, :, None] + position[None]).min(axis=1)


def expand(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per part, order and step, from the counts of each part (at most 128)."""
    orders, position, step = removal_steps()
    n_filters, n_orders = position.shape
    by_step = np.argsort(position, axis=0).T.reshape(-1)                 # the filter of each (order, step) cell
    column = np.arange(n_orders)
    leaves = np.isfinite(step)
    cell = (column * n_filters + np.where(leaves, step, 1) - 1).astype(int)
    name = np.repeat(orders, n_filters)
    place = np.tile(np.arange(1, n_filters + 1, dtype=np.int32), n_orders)
    fails = (np.arange(1 << n_filters)[:, None] >> by_step & 1) == 1     # does the pattern fail the cell's filter
    redundant = fails & (np.repeat(step, n_filters, axis=1) < place)
    alone = np.arange(1 << n_filters)[:, None] == 1 << by_step
    for batch in parts:
        for part, counts in zip(batch["part"], batch["counts"]):
            n = np.zeros((1 << n_filters, 3), np.int64)
            for c in counts:
                n[c["pattern"]] += np.array([1, c["good"], c["toxic"]], np.int64) * c["n"]
            gone = np.zeros((len(place), 3), np.int64)
            pattern, order = np.nonzero(leaves)
            np.add.at(gone, cell[pattern, order], n[pattern])
            removed = gone[:, 0]
            shapley = np.zeros(n_filters, np.int64)
            np.add.at(shapley, by_step, removed)
            kept = n[:, 0].sum() - removed.reshape(n_orders, n_filters).cumsum(axis=1).reshape(-1)
            yield pd.DataFrame({
                "part": part, "filter_order": name, "step": place, "kept": kept, "removed": removed,
                "redundant": n[:, 0] @ redundant, "unique_fails": n[:, 0] @ alone,
                "good_lost": gone[:, 1], "toxic_lost": gone[:, 2], "shapley": shapley[by_step]})


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)."""
    counts = failure_patterns(docs, labels).groupBy("part").agg(
        F.collect_list(F.struct("pattern", F.col("good").cast("int").alias("good"),
                                F.col("toxic").cast("int").alias("toxic"), "n")).alias("counts"))
    return counts.mapInPandas(expand, SCHEMA)
