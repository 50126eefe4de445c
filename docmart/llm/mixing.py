"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words.  A document of a source whose
target is r times its size first gets floor(r) certain whole copies.  The rest
is a sample without replacement: documents are ranked by random odds over
inclusion odds, (u / (1 - u)) / (p / (1 - p)).  p is the remaining share times
the document's weight over the source's mean weight by word, so the expected
words are the missing ones; without a ``weight`` column a document weighs
floor(sqrt(size)), so longer ones are likelier.  u comes from a hash of doc_id,
so reruns agree.

Documents are taken in that order while they fit into the words that are still
missing.  A document that does not fit is passed over: ``PASSES`` passes go on
with those documents that are no larger than the rest, and the last of them
takes, of those up to twice as large, also the one that comes nearer to the
target than its absence would.

No pass sorts a source in one task: words are summed over 65,536 bins of the
rank first, and only the one bin in which the rest is used up is sorted.  Of a
pass only its end is kept, a row per source: the first document (by rank,
doc_id, size) that does not fit.  Equal rows are taken together or not at all.

A null text has size 0; a null source is a source of its own, last in order.
Repeated rows are documents of their own.  A document larger than its source's
rest is not sampled, whatever its odds.  An empty table gives an empty mix.
Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NOT_WS, ranked, stored

WEIGHTS = (5, 2, 1)         # fixed values: by place of the source, repeating
MOST = 3                    # a target stops at so many times its source's size
BINS = 65_536
PASSES = 3
BROADCAST_SOURCES = 100_000   # rows of the source table; beyond, it is joined by shuffle


def size_of(text: Column) -> Column:
    """Words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(NOT_WS)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target): all words shared by weight, targets capped, the excess reshared by weight.

    Resharing until none is above its cap ends at one level L with target =
    min(cap, L * weight).  Each round is one aggregate over the sources; a
    source that is capped stays capped, since L only rises.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = ranked(by_source, [F.col("source").asc_nulls_last()], "place", "sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]),
                          (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    src = stored(placed.select("source", "source_size", weight.alias("weight"),
                               (F.col("source_size") * float(MOST)).alias("cap")), "weights")
    total = src.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > F.col("cap")
        row = src.agg(F.sum(F.when(over, F.col("cap")).otherwise(0.0)).alias("fixed"),
                      F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("open"),
                      F.count(F.when(over, 1)).alias("n")).first()
        if row["n"] == capped or not row["open"]:
            break
        capped, level = row["n"], (total - row["fixed"]) / row["open"]
    return src.select("source", "source_size", F.least(F.col("weight") * F.lit(level), "cap").alias("target"))


def uniform(doc_id: Column, seed: str) -> Column:
    """A number in (0, 1) from a hash of doc_id."""
    digits = F.substring(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(seed)).cast("binary")), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 48)


_PLACE = ("rank", "doc_id", "size")


def _limit(n: int) -> Column:
    """The largest size that takes part in pass ``n``, by the words ``left<n>`` that are missing then."""
    return F.col(f"left{n}") * (2.0 if n == PASSES - 1 else 1.0)


def _taken(n: int) -> Column:
    """Whether an open row is taken in one of the first ``n`` passes."""
    out, place = F.lit(False), F.struct(*_PLACE)
    for k in range(n):
        stop = F.col(f"stop{k}")
        end = F.struct(*[stop[c].alias(c) for c in _PLACE])
        fits = stop.isNull() | (place < end)
        if k == PASSES - 1:
            fits = fits | (stop["nearer"] & place.eqNullSafe(end))
        out = out | ((F.col("size") <= _limit(k)) & fits)
    return out


def _pass(rows: DataFrame, goal: DataFrame, n: int) -> DataFrame:
    """``goal`` with ``stop<n>``, the first row that no longer fits (null: all do), and the words left after the pass."""
    left = F.col(f"left{n}")
    tried = rows.where(~_taken(n) & (F.col("size") <= _limit(n)))
    bins = tried.groupBy("_key", f"left{n}", "bin").agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("_key").orderBy("bin"))     # at most BINS rows a source
    bins = bins.withColumn("upto", upto)
    # the first bin in which the words run out: nothing before it can fail to fit
    ends = bins.groupBy("_key").agg(F.sum("words").alias("all"), F.min(F.when(F.col("upto") > left, F.struct(
        "bin", (F.col("upto") - F.col("words")).alias("before")))).alias("end"))
    inside = tried.join(ends.where("end is not null"), "_key").where(F.col("bin") == F.col("end.bin"))
    inside = inside.withColumn("upto", F.col("end.before") + F.sum("size").over(Window.partitionBy("_key").orderBy(*_PLACE)))
    nearer = F.col("upto") - F.col("size") / 2 <= left          # to the target with it than without it
    cut = inside.groupBy("_key").agg(
        F.min(F.when(F.col("upto") > left, F.struct(*_PLACE, nearer.alias("nearer")))).alias(f"stop{n}"),
        F.max(F.when(F.col("upto") <= left, F.col("upto"))).alias("filled"))
    done = ends.join(cut, "_key", "left").select(
        "_key", f"stop{n}", F.when(F.col("end").isNull(), F.col("all")).otherwise(F.coalesce("filled", "end.before")).alias("got"))
    return stored(goal.join(done, "_key", "left").withColumn(f"left{n + 1}", left - F.coalesce("got", F.lit(0))).drop("got"),
                  f"pass{n}")


def mix(docs: DataFrame, weight: str | None = None, seed: str = ":mix") -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) of every row of ``docs``."""
    size = size_of(F.col("text"))
    w = F.coalesce(F.col(weight).cast("double"), F.lit(1.0)) if weight else F.greatest(F.floor(F.sqrt(size)), F.lit(1)).cast("double")
    sizes = stored(docs.select("doc_id", "source", size.alias("size"),
                               uniform(F.col("doc_id"), seed).alias("u"), w.alias("w")), "sizes")
    # nulls as a key of their own that no source can equal
    keyed = lambda df: df.withColumn("_key", F.struct(F.col("source").isNull().alias("none"),
                                                      F.coalesce("source", F.lit("")).alias("name")))
    goal = keyed(targets(sizes)).join(
        keyed(sizes.groupBy("source").agg((F.sum(F.col("w") * F.col("size")) / F.sum("size")).alias("mean_w")))
        .drop("source"), "_key")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goal = stored(goal.withColumn("whole", F.floor(ratio)).withColumn("part", ratio - F.col("whole"))
                  .withColumn("left0", F.col("target") - F.col("whole") * F.col("source_size")).drop("source"), "targets")
    few = goal.count() <= BROADCAST_SOURCES

    def ranked_rows(goal: DataFrame) -> DataFrame:
        p = F.least(F.greatest(F.col("part") * F.col("w") / F.coalesce("mean_w", F.lit(1.0)), F.lit(1e-9)), F.lit(1 - 1e-9))
        odds = (F.col("u") / (1 - F.col("u"))) / (p / (1 - p))
        return keyed(sizes).join(F.broadcast(goal) if few else goal, "_key").withColumn("rank", odds / (1 + odds)).withColumn(
            "bin", F.least(F.floor(F.col("rank") * BINS), F.lit(BINS - 1)))

    open_row = (F.col("part") > 0) & (F.col("size") > 0)
    for n in range(PASSES):
        goal = _pass(ranked_rows(goal).where(open_row), goal, n)
    copies = (F.col("whole") + (open_row & _taken(PASSES)).cast("int")).cast("int")
    return ranked_rows(goal).select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                                    (F.col("size") * copies).alias("taken"))
