"""Spelling variant grouping: words one edit apart, found by a frontier that walks a trie.

Two words are near if one inserted, deleted or replaced code point makes one
of them the other.  That edit lies in the second half of a word or in the first
half, that is in the second part of the reversed word; so each word walks two
tries, of all words and of all reversed words, and may only err after the half
that it enters with.  Every word ends with END.

The walk goes level by level.  At level k the trie is an edge table (node,
character, child), a node being the hash of a prefix of k characters; it is
one aggregate over the words whose node still holds more than two words.  A
child of at most two words is a leaf and keeps both.  The frontier holds
(word, shift, edits, node): what the walk has read of the word is k + shift.
It joins the edges on the node; each character either matches, or, as long as
there was no edit, replaces, is added to or stands behind a dropped character.
An added or dropped character counts as the last of a run of equal ones, so no
state is reached twice.  A state that has erred moves to a child only if words
below go on with the next character and the next pair that it needs; at a leaf it is compared with the
leaf's words, and those exactly one edit away are its neighbours.  Words of one
leaf are compared with each other, as their walks would start below it.

A level's edges and states are spread by node; a third of all words under one
prefix are combined before the shuffle by the aggregate, and split by the join
as any skewed key.  Where no inner node branches for 2 ** j more characters, the
walk takes them in one step: along such a chain words that did not err can only
match.  So very long words cost few levels.  Hashes only lead the walk: neighbours are compared as
words, so equal hashes cannot make a false one.

Null texts hold no words; a null doc_id is written as the empty text; repeated
rows count again; an empty table gives no rows.  Words of any length take part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import _AZ, _az, stored

MIN_LENGTH, MIN_COUNT, DELETE_EVERY, FORM_RATIO = 7, 2, 31, 10
END = " "                        # not a letter
JUMPS = 24                       # a step along a chain takes up to 2 ** (JUMPS - 1) characters
_COUNTED = 100_000               # words that a task counts before it passes them on (memory only)
_LOWER = str.maketrans(_AZ, _az)


def word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(word, n): partial counts of the lower-cased runs, some with a letter deleted by rule."""
    runs = re.compile("[A-Za-zÀ-ÿ]{%d,}" % MIN_LENGTH)
    counts: Counter = Counter()
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            for word, n in Counter(runs.findall(text)).items():
                word = word.translate(_LOWER)
                h = zlib.crc32(f"{doc_id}:{word}".encode())
                if h % DELETE_EVERY == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1:]
                if len(word) >= MIN_LENGTH:
                    counts[word] += n
            if len(counts) > _COUNTED:
                yield pd.DataFrame(list(counts.items()), columns=["word", "n"])
                counts.clear()
    yield pd.DataFrame(list(counts.items()), columns=["word", "n"]).astype({"n": "int64"})


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the words that occur often enough, over all documents."""
    texts = docs.where("text is not null").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    return (texts.mapInPandas(word_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= MIN_COUNT))


def letter(text: Column, at: Column) -> Column:
    """The character of ``text`` at a place from 0."""
    return F.substring(text, at + 1, F.lit(1))


def bit(c: Column) -> Column:
    """One of 64 bits for a character."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.ascii(c), F.lit(61)))


def pair_bit(pair: Column) -> Column:
    """One of 64 bits for two characters (one if the word ends with it)."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(pair), F.lit(64)).cast("int"))


def node_at(word: Column, depth: Column) -> Column:
    return F.xxhash64("reversed", F.substring(word, F.lit(1), depth))


def one_edit(a: Column, b: Column) -> Column:
    return F.levenshtein(a, b, 1) == 1


def edges_at(walking: DataFrame, k: int) -> DataFrame:
    """(node, c, child, size, lo, hi, next, next_pair): the trie between the levels k and k + 1; ``lo`` and ``hi`` are
    all words below if ``size`` is at most 2, ``next`` and ``next_pair`` have the bits of what follows."""
    word = F.col("word")
    return (walking.withColumn("child", node_at(word, F.lit(k + 1)))
            .withColumn("follows", F.when(F.char_length(word) > k + 1, bit(letter(word, F.lit(k + 1)))).otherwise(0))
            .withColumn("pair", pair_bit(F.substring(word, k + 2, 2)))
            .groupBy("child", "node", "reversed", letter(word, F.lit(k)).alias("c")).agg(
                F.count(F.lit(1)).alias("size"),
                F.min("word").alias("lo"), F.max("word").alias("hi"), F.bit_or("follows").alias("next"),
                F.bit_or("pair").alias("next_pair")))


def step(states: DataFrame, edges: DataFrame, k: int) -> DataFrame:
    """The frontier after one more character of the trie: (word, reversed, node, near, shift, edits), where ``near``
    has the neighbours if the child is a leaf and is null else; leaves without neighbours end the walk."""
    word, c, at = F.col("word"), F.col("c"), F.lit(k) + F.col("shift")
    here, after = letter(word, at), letter(word, at + 1)
    clean = F.col("edits") == 0

    def goes_on(place):     # some word below the child goes on with what ``word`` has from this place
        return (F.col("next").bitwiseAND(bit(letter(word, place))) != 0) & (
            F.col("next_pair").bitwiseAND(pair_bit(F.substring(word, place + 1, F.lit(2)))) != 0)

    same = (c == here) & (clean | (c == END) | goes_on(at + 1))
    other = clean & (c != here)
    replaced = other & (c != END) & (here != END) & goes_on(at + 1)
    added = other & (c != END) & goes_on(at)
    dropped = other & (here != END) & (c == after) & ((c == END) | goes_on(at + 2))
    move = lambda when, shift, edits: F.when(when, F.struct(
        (F.col("shift") + shift).cast("int").alias("shift"), F.lit(edits).alias("edits")))
    edited = F.array(move(replaced, 0, 1), move(added, -1, 1), move(dropped, 1, 1))
    moves = F.when(c == here, F.array(F.struct(F.col("shift"), F.col("edits")))).otherwise(edited)
    leaf = F.col("size") <= 2
    goal = ~leaf | one_edit(F.col("lo"), word) | one_edit(F.col("hi"), word)
    joined = states.join(edges, (states["node"] == edges["node"]) & (same | replaced | added | dropped) & goal)
    ends = F.filter(F.array_distinct(F.array("lo", "hi")), lambda w: one_edit(w, word))
    # what a leaf's walk was does not matter, one row will do
    left = F.when(leaf, F.array(F.struct(F.col("shift"), F.col("edits")))).otherwise(F.filter(moves, lambda m: m.isNotNull()))
    return (joined.select("word", states["reversed"], F.col("child").alias("node"), F.when(leaf, ends).alias("near"),
                          F.explode(left).alias("move"))
            .select("word", "reversed", "node", "near", "move.*"))


def chain_below(inner: DataFrame, k: int) -> int | None:
    """How many characters all inner nodes (lo, hi) of level ``k`` go on without a branch, as a power of two or 0;
    None if there is no inner node.  The first and last word below a node share what all words below it share."""
    lo, hi = F.col("lo"), F.col("hi")
    row = inner.agg(F.count(F.lit(1)), *[
        F.bool_and(F.substring(lo, F.lit(1), F.lit(k + (1 << j))) == F.substring(hi, F.lit(1), F.lit(k + (1 << j))))
        for j in range(JUMPS)]).first()
    if not row[0]:
        return None
    return max((1 << j for j in range(JUMPS) if row[1 + j]), default=0)


def along(states: DataFrame, inner: DataFrame, k: int, to: int) -> DataFrame:
    """The states of level ``k`` that match the chains below their nodes up to level ``to``."""
    length = F.lit(to - k)
    matches = F.substring("word", F.lit(k) + F.col("shift") + 1, length) == F.substring("lo", F.lit(k + 1), length)
    return (states.join(inner.select("node", "lo"), "node").where(matches)
            .select("word", "reversed", "shift", "edits", node_at(F.col("lo"), F.lit(to)).alias("node")))


def _plain(c: Column) -> Column:
    """The word as it is read: without END, turned back."""
    return F.when(F.col("reversed"), F.reverse(F.rtrim(c))).otherwise(F.rtrim(c))


def neighbours(words: DataFrame) -> DataFrame:
    """(word, near): all pairs of distinct ``words`` that are exactly one edit apart, both ways round."""
    half = F.floor(F.char_length("word") / 2).cast("int")
    both = words.select("word", F.lit(False).alias("reversed"), half.alias("enters")).union(
        words.select(F.reverse("word"), F.lit(True), F.char_length("word") - half))
    both = stored(both.select(F.concat("word", F.lit(END)).alias("word"), "reversed", "enters"), "walkers")
    first = both.agg(F.min("enters")).first()[0]
    found = None
    if first is not None:
        walking, k = both.withColumn("node", node_at(F.col("word"), F.lit(first))), first
        states = walking.where(F.col("enters") == first).select(
            "word", "reversed", F.lit(0).alias("shift"), F.lit(0).alias("edits"), "node")
        while True:
            edges = stored(edges_at(walking, k), "edges")
            moved = stored(step(states, edges.drop("reversed"), k), "frontier")
            pairs = moved.where("near is not null").select("word", "reversed", F.explode("near").alias("near"))
            twins = edges.where("size = 2").withColumnRenamed("lo", "word").where(one_edit(F.col("word"), F.col("hi")))
            pairs = pairs.union(twins.select("word", "reversed", F.col("hi").alias("near"))) \
                .union(twins.select(F.col("hi"), "reversed", "word"))
            pairs = stored(pairs.select(_plain(F.col("word")).alias("word"), _plain(F.col("near")).alias("near")), "near")
            found = pairs if found is None else found.union(pairs)
            inner = edges.where("size > 2").select(F.col("child").alias("node"), "lo", "hi")
            ahead = chain_below(inner, k + 1)
            if ahead is None:
                break
            states = moved.where("near is null").select("word", "reversed", "shift", "edits", "node")
            k, at = k + 1 + ahead, k + 1
            if ahead:
                states = along(states, inner, at, k)
            walking = stored(walking.withColumn("node", node_at(F.col("word"), F.lit(at)))
                             .join(inner.select("node"), "node", "left_semi")
                             .withColumn("node", node_at(F.col("word"), F.lit(k))), "walking")
            entering = walking.where(F.col("enters").between(at, k)).select(
                "word", "reversed", F.lit(0).alias("shift"), F.lit(0).alias("edits"), "node")
            states = states.unionByName(entering)
    if found is None:
        return words.select("word", F.col("word").alias("near")).limit(0)
    return found.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the last word that forms lead to, by doubling the steps."""
    at = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = stored(at.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                            F.col("further").isNotNull().alias("moved")), "roots")
        at = new.select("word", "root")
        if new.where("moved").limit(1).count() == 0:
            return at


def variants(docs: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word."""
    words = stored(vocabulary(docs), "vocabulary")
    pairs = neighbours(words.select("word"))
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("near").alias("word")))
    near = (pairs.join(words.withColumnRenamed("word", "near"), "near").groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"), best.alias("best")))
    with_form = F.col("best.less") * -1 >= F.col("n") * FORM_RATIO
    rows = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(with_form, F.col("best.word")).alias("form"), F.when(with_form, -F.col("best.less")).alias("form_n")), "forms")
    ends = roots(rows.where("form is not null"))
    return rows.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
