"""Benchmark decontamination by templates.

Texts become templates: words are lower-cased and stripped of punctuation,
numbers, units after numbers and names (capitalised inside a sentence) become
typed placeholders that keep their value as a slot; a run of capitalised words
is one name; a sign of arithmetic after a number or unit is a word.  Windows of ``WINDOW`` template words of a document are hash-joined
with those of the benchmark items; windows of fewer than half literal words meet
only if the values of their slots are equal.  Items shorter than a window are one
window of their own length.

Matches are gathered per document, item and alignment (document position minus
item position), and also over alignments that lie within ``NEAR`` words of each
other, as a longer value moves the rest of a text.  They are a leak if they cover
at least ``COVER`` of the item's windows, or of those with half literal words, or
``RUN`` windows, and their slots are consistent: one value of
the item always stands for one value of the document, as in a question that
only had its numbers or names exchanged.

Null and empty texts leak nothing; repeated rows of a doc_id count as one
document; rows with a null doc_id or item_id cannot be named and are left out
of the result (and kept by ``clean``).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .tokens import map_pieces, mix

WINDOW, COVER, RUN, CONSISTENT, NEAR = 8, 0.5, 12, 0.9, 8
BROADCAST_WINDOWS = 2_000_000     # of the benchmark (16 MB of hashes); beyond, all windows are shuffled
# Units that follow a number.
UNITS = frozenset("""mm cm m km in ft mi mg g kg lb oz ml l s sec min h hr hours hour day days week weeks month months
year years minutes minute seconds second meters metres miles inches feet grams kilograms pounds liters litres dollars
cents euros percent degrees mph kmh""".split())

# Signs of arithmetic that stand alone.
SIGNS = frozenset("+ - * / = ^ < > × ÷ −".split())

_LIT, _NUM, _UNIT, _CAP, _SIGN = 0, 1, 2, 3, 4
_KIND, _ENDS, _CLOSES = 7, 8, 16        # parts of a word's flags: its kind, ends a sentence, ends a name
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_NUMBER = re.compile(r"[+-]?[$€£]?\d+(?:[.,:/]\d+)*(?:%|st|nd|rd|th)?")
_P = np.uint64(0x9E3779B97F4A7C15)
_KEEP = 100_000           # words of a task's cache (memory only, results do not depend on it)


class _Words(dict):
    """word -> row of what is known of it (core, hash, flags); forgets all when full."""

    def __init__(self) -> None:
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.cores: list[str] = []
        self.hashes, self.flags = np.zeros(1 << 12, np.uint64), np.zeros(1 << 12, np.int8)

    def __missing__(self, word: str) -> int:
        core = word if word.isalnum() or word in SIGNS else _EDGE.sub("", word)
        low = core.lower()
        row = len(self.cores)
        if row == len(self.hashes):
            self.hashes, self.flags = (np.concatenate([a, np.zeros_like(a)]) for a in (self.hashes, self.flags))
        kind = _SIGN if word in SIGNS else _NUM if core[:1].isdecimal() and _NUMBER.fullmatch(core) else _UNIT if low in UNITS \
            else _CAP if core[:1].isupper() and core[1:].islower() else _LIT
        self.cores.append(low)
        if low:
            self.hashes[row] = xxhash.xxh3_64_intdigest(low.encode("utf-8", "surrogatepass"))
        self.flags[row] = (kind | (_ENDS if word[-1] in ".!?:;" or not core or kind == _SIGN else 0)
                           | (0 if word[-1].isalnum() else _CLOSES))
        self[word] = row
        return row

    def of(self, text: str, inside: bool = False):
        """Template of a text: hashes and kinds of its entries, their first words, and the rows of all words.

        With ``inside`` the text does not start a sentence.
        """
        if len(self) > _KEEP:
            self.forget()
        words = text.split()
        rows = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        hashes, flags = self.hashes[rows], self.flags[rows]
        kinds = flags & _KIND
        full = hashes != 0
        if kinds.any():
            start = np.ones(len(rows), bool)            # of a sentence: a capital says nothing there
            start[:1] = not inside
            start[1:] = flags[:-1] & _ENDS
            kinds[(kinds == _CAP) & start] = _LIT
            after = np.zeros(len(rows), bool)
            after[1:] = kinds[:-1] == _NUM
            kinds[(kinds == _UNIT) & ~after] = _LIT
            after[1:] |= kinds[:-1] == _UNIT
            sign = kinds == _SIGN
            full &= ~sign | after
            kinds[sign] = _LIT
        if not full.all():
            rows, hashes, flags, kinds = rows[full], hashes[full], flags[full], kinds[full]
        name = np.zeros(len(rows), bool)            # goes on
        name[1:] = (kinds[1:] == _CAP) & (kinds[:-1] == _CAP) & (flags[:-1] & _CLOSES == 0)
        first = np.flatnonzero(~name)
        if len(first) < len(rows):
            hashes, kinds = hashes[first], kinds[first]
        return np.where(kinds == _LIT, hashes, kinds.astype(np.uint64) * _P), kinds, first, rows

    def exact(self, kinds: np.ndarray, first: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Hashes of a template's entries with their values."""
        nth = (np.arange(len(rows)) - np.repeat(first, np.diff(np.append(first, len(rows))))).astype(np.uint64)
        values = np.add.reduceat(mix(self.hashes[rows] + nth * _P), first)
        return mix(values + kinds.astype(np.uint64) * _P)       # a word and the same word as a name are two

    def windows(self, h: np.ndarray, kinds: np.ndarray, first: np.ndarray, rows: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
        """A hash for every window, and which have fewer than half literal words: their hash holds the values."""
        n = len(h) - w + 1
        acc = _rolled(lambda j: h[j:j + n], w)
        heavy = np.zeros(n, bool)
        if kinds.any():
            literal = np.concatenate([[0], np.cumsum(kinds == _LIT)])
            heavy = 2 * (literal[w:] - literal[:-w]) < w
            at = np.flatnonzero(heavy)
            if len(at):         # values matter in these windows alone
                values = self.exact(kinds, first, rows)
                acc[at] = mix(_rolled(lambda j: values[at + j], w) + _P)
        return acc, heavy


def _rolled(entries: Callable[[int], np.ndarray], w: int) -> np.ndarray:
    """A polynomial hash of ``w`` entries; ``entries(j)`` are the j-th ones of all windows."""
    acc = entries(0).copy()
    for j in range(1, w):
        acc *= _P
        acc += entries(j)
    return mix(acc)


def _slots(table: _Words, kinds: np.ndarray, first: np.ndarray, rows: np.ndarray, at: int, w: int) -> list[str]:
    last = np.append(first[at + 1:at + w + 1], len(rows))
    return [" ".join(table.cores[x] for x in rows[first[at + i]:last[i]]) for i in range(w) if kinds[at + i] != _LIT]


_OUT = "id long, pos int, n int, w int, hash long, heavy boolean, slots array<string>"


def _windows(lengths: list[int], only: np.ndarray | None, short: bool):
    """Rows of all windows of a text: of WINDOW words, and of the given shorter lengths (of the whole, if ``short``)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = _Words()
        if only is not None:
            bloom = np.zeros(1 << 20, bool)
            bloom[(only & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        for batch in batches:
            out = []
            for id_, text in zip(batch["id"], batch["text"]):
                if not text:
                    continue
                # an item's first word may stand inside a sentence of the document, where its capital reads as a name
                for inside in ((False, True) if short else (False,)):
                    h, kinds, first, rows = table.of(text, inside)
                    n = len(h)
                    sizes = ([WINDOW] if n >= WINDOW else [n] * (n > 0)) if short else [w for w in lengths if w <= n]
                    if inside and n and kinds[0] != _CAP:
                        continue
                    for w in sizes:
                        acc, heavy = table.windows(h, kinds, first, rows, w)
                        at = np.arange(len(acc))
                        if only is not None:
                            at = at[bloom[(acc & np.uint64((1 << 20) - 1)).astype(np.int64)]]
                            if len(at):
                                x = acc[at]
                                i = np.minimum(np.searchsorted(only, x), len(only) - 1)
                                at = at[only[i] == x]
                        for p in at:
                            if not inside or p == 0:
                                out.append((id_, p, n, w, acc[p].view(np.int64), heavy[p], _slots(table, kinds, first, rows, p, w)))
            yield pd.DataFrame(out, columns=["id", "pos", "n", "w", "hash", "heavy", "slots"])
    return run


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    items = benchmark.select(F.col("item_id").cast("long").alias("id"), "text").where("item_id is not null and text is not null")
    return stored(map_pieces(items, _windows([], None, True), _OUT), "benchmark_windows")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, windows, item_windows, slots, consistency, verbatim): one row per leak of an item in a document."""
    items = benchmark_windows(benchmark)
    lengths = sorted(r["w"] for r in items.select("w").distinct().collect())      # at most WINDOW values
    n = items.count()
    only = None
    if n <= BROADCAST_WINDOWS:
        only = np.unique(np.array([r["hash"] for r in items.select("hash").distinct().collect()], np.int64).view(np.uint64))
    named = docs.select(F.col("doc_id").cast("long").alias("id"), "text").where("doc_id is not null and text is not null")
    if only is not None and not len(only):
        named = named.limit(0)
    found = stored(map_pieces(named, _windows(lengths, only, False), _OUT).distinct(), "document_windows")
    total = items.groupBy(F.col("id").alias("item_id")).agg(
        F.countDistinct("pos").alias("item_windows"), F.countDistinct(F.when(~F.col("heavy"), F.col("pos"))).alias("item_plain"))
    hits = (found.select(F.col("id").alias("doc_id"), F.col("pos").alias("at"), "w", "hash", F.col("slots").alias("there"))
            .join(items.select(F.col("id").alias("item_id"), "pos", "w", "hash", "heavy", "slots"), ["hash", "w"])
            .withColumn("shift", F.col("at") - F.col("pos")))
    # each alignment by itself, and in two rows of ranges, so any that span NEAR words meet in a range
    ranges = [F.struct(F.lit(i).alias("row"), F.floor((F.col("shift") + F.lit(i * NEAR)) / (2 * NEAR)).alias("at")) for i in range(2)]
    alone = F.struct(F.lit(2).alias("row"), F.col("shift").cast("long").alias("at"))
    hits = hits.withColumn("shift", F.explode(F.array(alone, *ranges)))
    by = ["doc_id", "item_id", "shift"]
    seen = hits.groupBy(by).agg(F.countDistinct("pos").alias("windows"),
                                F.countDistinct(F.when(~F.col("heavy"), F.col("pos"))).alias("plain"))
    pairs = (hits.select(*by, "at", F.posexplode(F.arrays_zip("slots", "there")).alias("i", "v"))
             .groupBy(*by, F.col("v.slots").alias("old"), F.col("v.there").alias("new")).agg(F.count(F.lit(1)).alias("n")))
    slots = (pairs.groupBy(*by, "old").agg(F.max("n").alias("most"), F.sum("n").alias("all"),
                                           F.max(F.when(F.col("old") == F.col("new"), F.col("n"))).alias("same"))
             .groupBy(by).agg(F.count(F.lit(1)).alias("slots"), (F.sum("most") / F.sum("all")).alias("consistency"),
                              (F.sum(F.coalesce("same", F.lit(0))) == F.sum("all")).alias("verbatim")))
    found = (seen.join(slots, by, "left").join(total, "item_id")
             .withColumn("slots", F.coalesce("slots", F.lit(0)))
             .withColumn("consistency", F.coalesce("consistency", F.lit(1.0)))
             .withColumn("verbatim", F.coalesce("verbatim", F.lit(True)))
             .where(((F.col("windows") >= COVER * F.col("item_windows")) | (F.col("windows") >= RUN)
                     | ((F.col("plain") > 0) & (F.col("plain") >= COVER * F.col("item_plain"))))
                    & (F.col("consistency") >= CONSISTENT)))
    best = F.max(F.struct("windows", "consistency", "verbatim", "item_windows", "slots")).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "b.windows", "b.item_windows", "b.slots", "b.consistency", "b.verbatim")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that leak an item."""
    bad = stored(leaks(docs, benchmark).select("doc_id").distinct(), "leaking")
    return docs.join(bad, "doc_id", "left_anti").select(docs.columns)
