"""Document fingerprints from closed syncmers over words.

A k-mer (k consecutive words) is an anchor when the smallest of its inner
s-mers is the first or the last one.  Whether a k-mer is chosen depends on its
own words alone, so an edit moves no anchor outside the k-mers it touches, and
every k - s consecutive k-mers hold at least one.  Anchors keep their word
position for positional matching (``anchors``, ``aligned_share``).  The
fingerprint is the ``SKETCH`` smallest distinct anchor hashes (32 bits each,
eight hex digits), and the likeness of two fingerprints is the bottom-sketch
estimate of the Jaccard similarity of their anchor sets.

A text of fewer than k words, or without any anchor, has one anchor: its whole
word sequence.  Null and empty texts have the empty fingerprint; two empty
fingerprints have likeness 1, an empty and another one 0.
Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import following_id, stored, words

K, S, SKETCH = 6, 2, 64
_INNER = K - S + 1


def _with_anchors(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: array<struct<pos, hash>>.  The steps are columns of their own, each computed once."""
    h, inner, pos = f"_h_{out}", f"_s_{out}", f"_p_{out}"
    n = F.size(h)
    return (
        df.withColumn(h, F.transform(words(F.col(text)), lambda w: F.xxhash64(w)))
        .withColumn(inner, F.when(n >= K, F.zip_with(F.slice(h, 1, n - 1), F.slice(h, 2, n - 1),
                                                     lambda a, b: F.xxhash64(a, b))))
        .withColumn(pos, F.when(n >= K, F.filter(F.sequence(F.lit(0), n - K), lambda i: F.array_min(
            F.slice(inner, i + 1, _INNER)) == F.least(F.get(inner, i), F.get(inner, i + _INNER - 1)))))
        .withColumn(out, F.when(n == 0, F.array().cast("array<struct<pos:int,hash:int>>"))
                    .when(F.coalesce(F.size(pos) > 0, F.lit(False)), F.transform(pos, lambda i: F.struct(
                        i.alias("pos"), F.shiftright(F.xxhash64(F.slice(h, i + 1, K)), 32).cast("int").alias("hash"))))
                    .otherwise(F.array(F.struct(
                        F.lit(0).alias("pos"), F.shiftright(F.xxhash64(F.col(h)), 32).cast("int").alias("hash")))))
        .drop(h, inner, pos))


def _sketch(anchors: str) -> Column:
    return F.slice(F.array_sort(F.array_distinct(F.col(f"{anchors}.hash"))), 1, SKETCH)


def _hex(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda x: F.lpad(F.lower(F.hex(
        x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: str, b: str) -> Column:
    """Of two sketch columns, 0 to 1 (null if one is missing)."""
    both = F.slice(F.array_sort(F.array_union(a, b)), 1, SKETCH)
    shared = F.size(F.array_intersect(both, F.array_intersect(a, b)))
    return (F.when(F.col(a).isNull() | F.col(b).isNull(), F.lit(None).cast("double"))
            .when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(shared / F.size(both)))


def anchors(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, hash): every anchor of every whole text, as rows."""
    return (_with_anchors(docs.select("doc_id", "text"), "text", "anchors")
            .select("doc_id", F.inline("anchors")))


def aligned_share(a: str, b: str) -> Column:
    """Of two anchor columns: the share of a's anchors found in b at one common shift of positions.

    For pairs already found; looks only at the shift of the first shared anchor.
    """
    hashes = F.col(f"{b}.hash")
    shift = F.element_at(F.filter(F.transform(F.col(a), lambda x: F.when(
        F.array_contains(hashes, x["hash"]), F.element_at(F.filter(
            F.col(b), lambda y: y["hash"] == x["hash"]), 1)["pos"] - x["pos"])), lambda d: d.isNotNull()), 1)
    moved = F.transform(F.col(a), lambda x: F.struct((x["pos"] + shift).alias("pos"), x["hash"].alias("hash")))
    return F.coalesce(F.size(F.array_intersect(moved, F.col(b))) / F.size(a), F.lit(0.0))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, n_anchors) of every row."""
    df = _with_anchors(docs.select("doc_id", "text"), "text", "anchors")
    return df.select("doc_id", _hex(_sketch("anchors")).alias("fingerprint"),
                     F.size("anchors").cast("long").alias("n_anchors"))


def with_next_tail(docs: DataFrame) -> DataFrame:
    """(doc_id, h, text, next_doc_id, next_h, tail): tail is the start of the next document's text,
    as many code points as floor(length / 4) of this one.

    Ids repeat only if rows repeat: the next document of an id is the next
    larger distinct id (its row of smallest text hash).  Rows with a null
    doc_id have no next document and an empty tail.
    """
    # a cast that changes nothing would leave an alias on one side of the joins alone, and two shuffles of the texts
    doc_id = F.col("doc_id") if dict(docs.dtypes)["doc_id"] == "bigint" else F.col("doc_id").cast("long")
    texts = docs.select(doc_id, F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    meta = stored(texts.where("doc_id is not null").select(
        "doc_id", "h", F.floor(F.char_length("text") / 4).cast("int").alias("cut")).distinct(), "lengths")
    after = following_id(meta, "doc_id")
    firsts = meta.groupBy(F.col("doc_id").alias("next_doc_id")).agg(F.min("h").alias("next_h"))
    need = stored(meta.join(after, "doc_id").join(firsts, "next_doc_id"), "needs")
    named = texts.where("doc_id is not null")
    # the texts keep their names on both joins, so one shuffle of them serves both
    need = need.select(F.col("doc_id").alias("own_id"), F.col("h").alias("own_h"), "cut",
                       F.col("next_doc_id").alias("doc_id"), F.col("next_h").alias("h"))
    tails = (named.join(need, ["doc_id", "h"])
             .select(F.col("own_id"), F.col("own_h"), F.col("doc_id").alias("next_doc_id"),
                     F.col("h").alias("next_h"), F.expr("substring(text, 1, cut)").alias("tail"))
             .dropDuplicates(["own_id", "own_h"]).withColumnsRenamed({"own_id": "doc_id", "own_h": "h"}))
    rest = texts.where("doc_id is null").select(
        "doc_id", "h", "text", F.lit(None).cast("long").alias("next_doc_id"),
        F.lit(None).cast("long").alias("next_h"), F.lit("").alias("tail"))
    return named.join(tails, ["doc_id", "h"]).select(rest.columns).unionByName(rest)


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """The digest of every row of ``docs``: its fingerprint, that of its edited text, and their likeness.

    Repeated rows give repeated results; see ``with_next_tail`` for ids.
    """
    both = with_next_tail(docs).withColumn("n_chars", F.char_length("text").cast("long")).withColumn(
        "edited", F.expr("concat(substring(text, 1, cast(n_chars - floor(n_chars / 4) as int)), tail)"))
    both = both.select("doc_id", "h", "next_doc_id", "next_h", "n_chars", "text", "edited",
                       F.sha2("edited", 256).alias("edited_sha256"))
    both = _with_anchors(_with_anchors(both, "text", "own"), "edited", "other").select(
        "doc_id", "h", "next_doc_id", "next_h", "n_chars", "edited_sha256", F.size("own").cast("long").alias("n_anchors"),
        _sketch("own").alias("own"), _sketch("other").alias("other"))
    both = stored(both, "fingerprints")
    following = (both.select(F.col("doc_id").alias("next_doc_id"), F.col("h").alias("next_h"),
                             F.col("own").alias("following"))
                 .where("next_doc_id is not null").dropDuplicates(["next_doc_id", "next_h"]))
    return both.join(following, ["next_doc_id", "next_h"], "left").select(
        "doc_id", "n_chars", "edited_sha256", _hex(F.col("own")).alias("fingerprint"),
        _hex(F.col("other")).alias("edited_fingerprint"), likeness("own", "other").alias("near_edited"),
        likeness("own", "following").alias("near_next"), "n_anchors")
