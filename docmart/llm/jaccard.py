"""N-gram Jaccard join by prefixes under several global token orders.

A document's set is its distinct word shingles (as 64-bit hashes).  Two sets
with 100 * |x & y| >= t * |x | y| share, under ANY global order of the tokens,
a token among their first |x| - ceil(t|x|/100) + 1.  Two independent orders
are used: a pair has to share a prefix token under the first (which finds it
by an equi-join) and under the second, before the whole sets are compared.
The first order puts the tokens that most prefixes hold last, so a passage that
many documents share stays out of the prefixes of those with other words; any
order loses no link, so how many tokens are put last changes the work only.
Two more lossless tests ride in the join condition: sizes, and the distance of
parity bitmaps, which never exceeds the symmetric difference.

Equal sets are one class; only its representative (smallest doc_id) is joined.
Links come in two passes.  First every document meets a few pivots of its
token buckets, which joins large groups of near copies at linear cost.  Then
all other pairs of a bucket are met, but only across components of the first
pass, so a group of near copies is never written out as pairs and no link
between different components is lost.

``jaccard_links`` is the join itself: every link between representatives, with no
filter by component.  ``jaccard_groups`` takes the two passes as a short cut.

Null or empty texts have the empty set and are linked with nothing.  Rows that
share a doc_id are one document for the links.  Rows with a null doc_id have a
set size but no component.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import components, drop_finished_shuffles, drop_stored, stored
from .tokens import WordHashes, map_pieces, mix, windows, words

_SKETCH = "doc_id long, n_shingles long, sig string, pa array<long>, b0 long, b1 long, b2 long, b3 long"
_SET = "doc_id long, n long, pb array<long>, counts array<short>, tokens array<long>"
_SECOND = np.uint64(0x5851F42D4C957F2D)
PIVOTS, PARTNERS = 4, 2     # first pass: pivots of a bucket, partners checked for a document
BROADCAST_IDS = 2_000_000   # ids (some 40 bytes each, 80 MB) up to which their texts are picked without a shuffle
_BUCKETS = 128
COMMON, MOST_COMMON = 16, 200_000   # tokens in more prefixes than COMMON come last; the MOST_COMMON most frequent (3 MB)


def _prefix(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1 if n else 0


def _sketcher(k: int, percent: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Size, signature, prefix under the first order and parity bitmap of every set."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                s = np.unique(windows(hashes.of(words(text)), k))
                odd = np.bincount((s & np.uint64(255)).astype(np.int64), minlength=256).astype(np.uint8) & 1
                bits = np.packbits(odd).view(np.int64)
                out.append((doc_id, len(s), xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None,
                            s[:_prefix(len(s), percent)].view(np.int64), *bits.tolist()))
            yield pd.DataFrame(out, columns=["doc_id", "n_shingles", "sig", "pa", "b0", "b1", "b2", "b3"]) \
                .astype({"doc_id": "Int64"})
    return run


def _prefixes(k: int, percent: int, last: np.ndarray, rank: np.ndarray) \
        -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Prefix under the first order: by ``rank`` (0 unless the token is in the sorted ``last``), then by hash."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                s = np.unique(windows(hashes.of(words(text)), k))
                at = np.minimum(np.searchsorted(last, s), len(last) - 1)
                order = np.argsort(np.where(last[at] == s, rank[at], 0), kind="stable")
                out.append((doc_id, s[order[:_prefix(len(s), percent)]].view(np.int64)))
            yield pd.DataFrame(out, columns=["doc_id", "pa"])
    return run


def _sets(k: int, percent: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Prefix under the second order, counts per bucket, and the set itself."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                s = np.unique(windows(hashes.of(words(text)), k))
                p = _prefix(len(s), percent)
                pb = s[np.argpartition(mix(s ^ _SECOND), p - 1)[:p]] if p else s
                buckets = ((s >> np.uint64(8)) & np.uint64(_BUCKETS - 1)).astype(np.int64)
                # cut counts lie no farther apart than whole ones, so the filter stays lossless
                counts = np.minimum(np.bincount(buckets, minlength=_BUCKETS), 32_767).astype(np.int16)
                out.append((doc_id, len(s), pb.view(np.int64), counts, s.view(np.int64)))
            yield pd.DataFrame(out, columns=["doc_id", "n", "pb", "counts", "tokens"])
    return run


def _may_link(percent: int) -> Column:
    """Sizes and parity bitmaps allow the similarity (never false for a link)."""
    apart = sum((F.bit_count(F.col(f"x.b{i}").bitwiseXOR(F.col(f"y.b{i}"))) for i in range(4)), F.lit(0))
    nx, ny = F.col("x.n_shingles"), F.col("y.n_shingles")
    return ((100 * F.least(nx, ny) >= percent * F.greatest(nx, ny))
            & ((100 - percent) * (nx + ny) >= (100 + percent) * apart))


def _sized(ids: DataFrame) -> DataFrame:
    """Stored ids, broadcast if they are few; else the join shuffles."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _heads(reps: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc_id, token): the prefixes under the first order, common tokens last.

    A prefix by hash alone that holds no common token is the prefix under the
    first order too, so only the other documents are read again.
    """
    heads = reps.select("doc_id", F.explode("pa").alias("token"))
    common = stored(heads.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > COMMON)
                    .orderBy(F.desc("n"), "token").limit(MOST_COMMON), "common")
    listed = common.toPandas()              # at most MOST_COMMON rows
    if listed.empty:
        return heads
    last, rank = listed["token"].to_numpy().view(np.uint64), np.frexp(listed["n"].to_numpy())[1]
    by_hash = np.argsort(last)
    again = stored(heads.join(F.broadcast(common.select("token")), "token", "left_semi").select("doc_id").distinct(), "again")
    ids = _sized(again)
    redone = map_pieces(docs.select("doc_id", "text").join(ids, "doc_id", "left_semi"),
                        _prefixes(k, percent, last[by_hash], rank[by_hash]), "doc_id long, pa array<long>")
    # a doc_id with several texts has the prefixes of them all
    redone = redone.select("doc_id", F.explode("pa").alias("token")).join(reps.select("doc_id"), "doc_id", "left_semi")
    # the shuffle by token serves both this distinct and the counts that follow
    return heads.join(ids, "doc_id", "left_anti").unionByName(redone).repartition("token").distinct()


def _few_files(pairs: DataFrame) -> DataFrame:
    """The same pairs in tasks by their size: tasks that joined whole sets would write a file of a few pairs each,
    and every file is a child process of the executor where Hadoop has no native library."""
    return pairs.repartition("a", "b")


def _verified(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The stored pairs (a, b) that also share a prefix token under the second order and whose whole sets link.

    Small columns are compared first: the counts of both sets' tokens in 128
    buckets differ by no more than the sets do.  Whole sets travel only for
    the pairs that are left.
    """
    pairs = stored(pairs, "candidates")
    ids = pairs.select("a").union(pairs.select("b")).toDF("doc_id").distinct()
    ids = stored(ids, "candidate_ids")
    texts = docs.select("doc_id", "text").join(_sized(ids), "doc_id", "left_semi")
    sets = stored(map_pieces(texts, _sets(k, percent), _SET), "sets")
    drop_finished_shuffles(docs.sparkSession)
    counts, prefixes = sets.select("doc_id", "n", "counts"), sets.select("doc_id", "pb")
    apart = F.aggregate(F.zip_with("ca", "cb", lambda x, y: F.abs(x - y).cast("long")), F.lit(0).cast("long"),
                        lambda t, d: t + d)
    near = (pairs.join(counts.toDF("a", "na", "ca"), "a").join(counts.toDF("b", "nb", "cb"), "b")
            .where((100 - percent) * (F.col("na") + F.col("nb")) >= (100 + percent) * apart).select("a", "b").distinct())
    near = (near.join(prefixes.toDF("a", "pa"), "a").join(prefixes.toDF("b", "pb"), "b")
            .where(F.arrays_overlap("pa", "pb")).select("a", "b").distinct())
    near = stored(_few_files(near), "near")
    drop_finished_shuffles(docs.sparkSession)
    tokens = sets.select("doc_id", "tokens")
    both = F.size(F.array_intersect("ta", "tb"))
    linked = (near.join(tokens.toDF("a", "ta"), "a").join(tokens.toDF("b", "tb"), "b")
              .where(100 * both >= percent * (F.size("ta") + F.size("tb") - both))
              .select("a", "b").distinct())
    linked = stored(_few_files(linked), "linked")
    drop_stored(pairs, ids, sets, near)
    drop_finished_shuffles(docs.sparkSession)
    return linked


def _prefix_rows(reps: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(token, doc_id, n_shingles, b0..b3): the prefixes under the first order, of tokens that several hold."""
    bits = reps.select("doc_id", "n_shingles", "b0", "b1", "b2", "b3")
    heads = _heads(reps, docs, k, percent)
    shared = (heads.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("token")))
              .where("_n > 1").drop("_n"))
    rows = stored(shared.join(bits, "doc_id"), "prefixes")
    drop_finished_shuffles(docs.sparkSession)
    return rows


def _links(reps: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) between classes that connect the same classes as all links do."""
    prefixes = _prefix_rows(reps, docs, k, percent)
    # one shuffle by token serves the pivots and the documents that meet them; it is reused as both sides
    # read the same rows, none of which is null
    rows = prefixes.where(" and ".join(f"{c} is not null" for c in prefixes.columns)).repartition("token")
    picks = [F.min_by(F.struct("doc_id", "n_shingles", "b0", "b1", "b2", "b3"),
                      F.xxhash64("doc_id", "token", F.lit(i))).alias(f"p{i}") for i in range(PIVOTS)]
    pivots = (rows.groupBy("token").agg(*picks)
              .select("token", F.explode(F.array_distinct(F.array(*[f"p{i}" for i in range(PIVOTS)]))).alias("p"))
              .select("token", "p.*"))
    x, y = rows.alias("x"), pivots.alias("y")
    apart = sum((F.bit_count(F.col(f"x.b{i}").bitwiseXOR(F.col(f"y.b{i}"))) for i in range(4)), F.lit(0))
    met = (x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.doc_id") != F.col("y.doc_id"))
                  & _may_link(percent))
           .select(F.col("x.doc_id").alias("x"), F.col("y.doc_id").alias("y"), apart.alias("apart")).distinct())
    nearest = Window.partitionBy("x").orderBy("apart", "y")       # at most PIVOTS * prefix rows each
    first = (met.withColumn("_r", F.row_number().over(nearest)).where(F.col("_r") <= PARTNERS)
             .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    first = _verified(first, docs, k, percent)

    part = components(first).toDF("doc_id", "component")
    rows = prefixes.join(part, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    x, y = rows.alias("x"), rows.alias("y")
    rest = (x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.doc_id") < F.col("y.doc_id"))
                   & (F.col("x.component") != F.col("y.component")) & _may_link(percent))
            .select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).distinct())
    second = _verified(rest, docs, k, percent)
    drop_stored(prefixes)
    return first.union(second)


def _classes(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sketches of all rows, the representatives of equal sets, and (doc_id, rep) of the named documents."""
    sketches = stored(map_pieces(docs, _sketcher(k, percent), _SKETCH), "sketches")
    named = sketches.where("doc_id is not null and n_shingles > 0")
    whole = F.struct("doc_id", "n_shingles", "pa", "b0", "b1", "b2", "b3")
    reps = stored(named.groupBy("sig").agg(F.min_by(whole, "doc_id").alias("r")).select("sig", "r.*"), "reps")
    member = stored(named.select("doc_id", "sig").join(reps.select("sig", F.col("doc_id").alias("rep")), "sig")
                    .select("doc_id", "rep").distinct(), "members")
    return sketches, reps, member


def jaccard_links(docs: DataFrame, k: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """The join: (a, b) with a < b of every two representatives whose sets link, and (doc_id, rep) of all documents.

    Two documents link if they have the same representative or theirs are a pair.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    _, reps, member = _classes(docs, k, percent)
    rows = _prefix_rows(reps, docs, k, percent)
    x, y = rows.alias("x"), rows.alias("y")
    pairs = (x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.doc_id") < F.col("y.doc_id")) & _may_link(percent))
             .select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).distinct())
    return _verified(pairs, docs, k, percent), member


def jaccard_groups(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    sketches, reps, member = _classes(docs, k, percent)
    # an id with several texts joins their classes
    twice = (member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"))
             .where("a <> b").select("doc_id"))
    same_id = member.join(twice, "doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    part = components(_links(reps, docs, k, percent).union(same_id)).toDF("rep", "found")
    found = (member.join(part, "rep", "left")
             .groupBy("doc_id").agg(F.min(F.coalesce("found", "rep")).alias("found")))
    return (sketches.select("doc_id", "n_shingles").join(found, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("found", "doc_id").alias("component_id")))


def one_of_each_group(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that link, directly or through others, to one of a smaller doc_id.

    Repeated rows of a kept doc_id are one document and stay as one; rows with
    a null doc_id and documents without words stay.
    """
    groups = stored(jaccard_groups(docs, k, percent), "groups")
    dropped = stored(groups.where("component_id < doc_id").select("doc_id").distinct(), "dropped")
    twice = stored(groups.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "twice")
    # only the texts of repeated ids have to meet
    left = docs.join(_sized(dropped), "doc_id", "left_anti")
    once = left.join(_sized(twice), "doc_id", "left_anti")
    return once.unionByName(left.join(_sized(twice), "doc_id", "left_semi").dropDuplicates(["doc_id"]))
