"""Quality score from two compressors.

One zstandard dictionary is built from good, one from bad labelled text.  A
text is cut into blocks of ``BLOCK`` bytes over its whole length and each block
is compressed with either dictionary; the normalised difference of the total
sizes, (bad - good) / mean, is positive where the good dictionary helps more.
A logistic curve, fitted on labelled documents that built no dictionary, turns
it into the probability of label 1.  Where both compressors shrink a text to
almost nothing (a word repeated on and on) their difference says little, so the
curve also sees the logarithm of the compression ratio and its square.

Fitting reads at most ``PER_CLASS`` documents of each label (chosen by hash),
and at most ``BLOCKS`` blocks of each, spread over the whole text.  Scoring
reads every whole text.  Null and empty texts have difference and logarithm 0.  With too
little labelled text for trained dictionaries the text itself is the
dictionary; without any text of a label the score is the share of label 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from .common import crc_mod, labelled_sample

PER_CLASS, BLOCKS, BLOCK = 2000, 6, 2048
DICTIONARY, LEVEL = 65_536, 3


def _blocks(text: str | None) -> list[bytes]:
    data = text.encode("utf-8", "surrogatepass") if text else b""
    return [data[i:i + BLOCK] for i in range(0, len(data), BLOCK)]


def _training_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for doc_id, text, label in zip(batch["doc_id"], batch["text"], batch["label"]):
            blocks = _blocks(text)
            for i in sorted({int(x) for x in np.linspace(0, len(blocks) - 1, BLOCKS)} if blocks else ()):
                out.append((doc_id, label, blocks[i]))
        yield pd.DataFrame(out, columns=["doc_id", "label", "block"])


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or with too little text the text itself."""
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


class Difference:
    """The normalised difference of a text's sizes under two dictionaries."""

    def __init__(self, good: bytes, bad: bytes) -> None:
        self.both = [self._compressor(d) for d in (good, bad)]

    @staticmethod
    def _compressor(raw: bytes):
        if not raw:
            return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)
        d = zstandard.ZstdCompressionDict(raw)
        d.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(dict_data=d, write_dict_id=False, write_content_size=False)

    def of(self, blocks: list[bytes]) -> tuple[float, float, float]:
        """Ten times the normalised difference; one more than the logarithm of the ratio, and its square."""
        if not blocks:
            return 0.0, 0.0, 0.0
        good, bad = (sum(len(c.compress(b)) for b in blocks) for c in self.both)
        ratio = 1.0 + float(np.log(good / sum(map(len, blocks))))
        return 20.0 * (bad - good) / (bad + good), ratio, ratio * ratio


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights of the columns of x (the last one is 1) by Newton steps."""
    w = np.zeros(x.shape[1])
    weight = weight / weight.sum()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - y)) + ridge * np.append(w[:-1], 0)
        h = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w = w - np.clip(step, -20, 20)
        if np.abs(step).max() < 1e-8:
            break
    return w


def class_weights(y: np.ndarray, labels: DataFrame, label: str, mod: int, held_out: int) -> tuple[np.ndarray, float]:
    """Weights that give the classes of a sample their shares among all labelled rows of the training folds; that share."""
    n = {r[0]: r[1] for r in labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
         .where(crc_mod(F.col("doc_id"), mod) != held_out).groupBy(F.col(label).cast("int")).count().collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    share = (n1 + 0.5) / (n0 + n1 + 1.0)
    have1 = max(int((y == 1).sum()), 1)
    have0 = max(int((y == 0).sum()), 1)
    return np.where(y == 1, share / have1, (1 - share) / have0), share


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", mod: int = 5, held_out: int = 0) -> dict:
    """The model: two dictionaries and a curve; a few hundred KB at most."""
    sample = labelled_sample(docs, labels, label, mod, held_out, PER_CLASS)
    rows = sample.mapInPandas(_training_blocks, "doc_id long, label int, block binary").collect()
    texts: dict[tuple[int, int], list[bytes]] = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], bytes(r["block"]))):
        texts.setdefault((r["doc_id"], r["label"]), []).append(bytes(r["block"]))
    part = {0: [], 1: []}
    for key, blocks in texts.items():
        part[key[1]].append(blocks)
    # of each class every second document builds the dictionary, the others fit the curve
    build = {c: part[c][::2] for c in part}
    size = min(sum(len(b) for d in build[c] for b in d) for c in build)      # as much text of either class
    dictionaries = {}
    for c in build:
        taken, so_far = [], 0
        for blocks in build[c]:
            if so_far >= size:
                break
            taken += blocks
            so_far += sum(map(len, blocks))
        dictionaries[c] = _dictionary(taken)
    diff = Difference(dictionaries[1], dictionaries[0])
    points = [(diff.of(b), c) for c in part for b in part[c][1::2]]
    y = np.array([c for _, c in points], float)
    weight, share = class_weights(y, labels, label, mod, held_out)
    curve = [0.0, 0.0, 0.0, float(np.log(share / (1 - share)))]
    if 0 < y.sum() < len(y):
        x = np.array([[*d, 1.0] for d, _ in points])
        curve = fit_logistic(x, y, weight, 1e-5).tolist()
    return {"good": dictionaries[1], "bad": dictionaries[0], "curve": curve}


def score(docs: DataFrame, model: dict, name: str = "score") -> DataFrame:
    """``docs`` with the column ``name``: the probability of label 1."""
    schema = StructType([f for f in docs.schema if f.name != name]).add(name, DoubleType())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        diff = Difference(model["good"], model["bad"])
        curve = np.array(model["curve"])
        for batch in batches:
            x = np.array([diff.of(_blocks(t)) for t in batch["text"]], float).reshape(-1, 3)
            yield batch.assign(**{name: 1 / (1 + np.exp(-np.clip(x @ curve[:3] + curve[3], -30, 30)))})[schema.names]

    return docs.mapInPandas(run, schema)


def quality(docs: DataFrame, labels: DataFrame, mod: int = 5, held_out: int = 0, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    model = fit(docs, labels, "quality", mod, held_out)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", (crc_mod(F.col("doc_id"), mod) == held_out).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
