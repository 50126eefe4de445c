"""Toxic spans by a linear-chain conditional random field.

Labels mark documents; the tokens of labelled documents get theirs from a
lexicon: words, or beginnings of words (5 to 9 letters, for inflected forms),
whose document frequency in toxic documents exceeds that in clean ones beyond
chance, in a document labelled toxic.  The field has two states (toxic,
other), weights for a word, its neighbours and its shape, and transitions; it
is trained by gradient steps on exact forward-backward marginals.  Every whole text is
then tagged; the marginals give the spans, and their largest and their sum give,
through a logistic curve fitted on labelled documents, the document's score.

Fitting reads at most ``PER_CLASS`` documents of each label (chosen by hash):
document frequencies over their whole texts, and at most ``WINDOWS`` windows
of each for the field.  Null and empty texts have no token and get the score
of a text without any toxic token.  Without toxic labels the score is their share.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from .common import crc_mod, labelled_sample
from .quality import class_weights, fit_logistic
from .tokens import give_back, pieces

PER_CLASS, WINDOWS, RADIUS, VOCABULARY = 1500, 4, 12, 4000
_STRIP = b".,!?;:\"'()[]{}<>*#%$&|-_~`"
_TOKEN = re.compile(r"[^\x20\x09-\x0d]+")
_STEPS = 80
_SHORTEST, _LONGEST = 5, 9
_REMEMBERED = 100_000      # tokens of a task's cache
_TEXTS = 500          # tagged together
_CELLS = 400_000      # of a padded block of texts in a task's memory


def _tokens(text: str | None) -> list[bytes]:
    return [w.strip(_STRIP) for w in text.encode("utf-8", "surrogatepass").lower().split()] if text else []


def _beginnings(w: bytes) -> list[bytes]:
    """The word's beginnings, marked, longest first."""
    text = w.decode("utf-8", "replace") if len(w) > _SHORTEST else ""
    return [text[:n].encode("utf-8", "replace") + b"*" for n in range(min(_LONGEST, len(text) - 1), _SHORTEST - 1, -1)]


def _distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in pieces(batches, 50):         # a text has some thousand beginnings of words
        words = [set(_tokens(t)) for t in batch["text"]]
        words = [sorted(ws.union(*map(_beginnings, ws))) for ws in words]
        yield pd.DataFrame({"word": [w for ws in words for w in ws],
                            "label": np.repeat(batch["label"].to_numpy(np.int32), [len(ws) for ws in words])})


def _lexicon(sample: DataFrame) -> tuple[list[bytes], list[bytes]]:
    """Toxic words, and the words to know at all (toxic ones, then the commonest), VOCABULARY at most."""
    n = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    freq = (sample.select("text", "label").mapInPandas(_distinct, "word binary, label int").where("length(word) > 0")
            .groupBy("word").agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c")))
    odds = F.log((F.col("t") + 0.5) / (n1 + 1.0)) - F.log((F.col("c") + 0.5) / (n0 + 1.0))
    sure = odds - 2.0 * F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    begins = F.substring("word", -1, 1) == F.lit(b"*")
    best = (freq.withColumn("toxic", (F.col("t") >= max(3.0, 0.005 * n1)) & (sure >= np.log(4.0)))
            .where(F.col("toxic") | ~begins).orderBy(F.desc("toxic"), F.desc(F.col("t") + F.col("c")), "word").limit(VOCABULARY).collect())
    return [bytes(r["word"]) for r in best if r["toxic"]], [bytes(r["word"]) for r in best]


class Ids(dict):
    """token as written (bytes) -> id of its word, else of its longest known beginning, else 0."""

    def __init__(self, known: dict[bytes, int]) -> None:
        super().__init__()
        self.known = known

    def __missing__(self, raw: bytes) -> int:
        w = raw.lower().strip(_STRIP)
        id_ = self.known.get(w, 0) or next((self.known[b] for b in _beginnings(w) if b in self.known), 0)
        if len(self) < _REMEMBERED:
            self[raw] = id_
        return id_


def _features(text: str | None, ids: Ids) -> tuple[np.ndarray, np.ndarray]:
    """Of every token: its word (0: unknown) and its shape (0 plain, 1 upper case, 2 with digits or marks)."""
    if not text:
        return np.zeros(0, np.int32), np.zeros(0, np.int8)
    raw = text.encode("utf-8", "surrogatepass").split()
    word = np.fromiter(map(ids.__getitem__, raw), np.int32, len(raw))
    shape = np.fromiter((1 if w.isupper() and len(w) > 1 else 0 if w.isalpha() else 2 for w in raw), np.int8, len(raw))
    return word, shape


def _training_windows(toxic: list[bytes], ids: dict[bytes, int]):
    bad = np.array(sorted(ids[w] for w in toxic), np.int32)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = Ids(ids)
        for batch in pieces(batches):
            out = []
            for doc_id, text, label in zip(batch["doc_id"], batch["text"], batch["label"]):
                word, shape = _features(text, table)
                if not len(word):
                    continue
                marked = np.isin(word, bad) if label else np.zeros(len(word), bool)
                at = np.flatnonzero(np.isin(word, bad))
                rng = np.random.default_rng(int(doc_id) & 0xFFFFFFFF)
                half = WINDOWS // 2
                at = np.concatenate([rng.permutation(at)[:half], rng.integers(0, len(word), half)])
                for p in at:
                    lo, hi = max(0, p - RADIUS), min(len(word), p + RADIUS + 1)
                    out.append((word[lo:hi].tolist(), shape[lo:hi].astype(int).tolist(), marked[lo:hi].astype(int).tolist()))
            yield pd.DataFrame(out, columns=["word", "shape", "y"])
    return run


def _neighbours(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    before, after = np.zeros_like(word), np.zeros_like(word)
    before[..., 1:], after[..., :-1] = word[..., :-1], word[..., 1:]
    return before, after


def _scores(m: dict, word: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """Of state 1 over state 0, for rows of texts padded with -1 in ``shape``."""
    before, after = _neighbours(word)
    u = m["word"][word] + m["before"][before] + m["after"][after] + m["shape"][shape] + m["bias"]
    return np.clip(u, -30, 30)


def _forward_backward(u: np.ndarray, live: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ratios of state 1 to state 0, forwards and backwards, and exp(u); one row per text, padding not ``live``."""
    e, t = np.exp(u).T.copy(), np.exp(a)
    live = live.T
    n = e.shape[0]
    f, b = np.empty_like(e), np.ones_like(e)
    f[0] = e[0]
    for i in range(1, n):
        f[i] = e[i] * (t[0, 1] + f[i - 1] * t[1, 1]) / (t[0, 0] + f[i - 1] * t[1, 0])
    for i in range(n - 2, -1, -1):
        x = e[i + 1] * b[i + 1]
        b[i] = np.where(live[i + 1], (t[1, 0] + t[1, 1] * x) / (t[0, 0] + t[0, 1] * x), 1.0)
    return f.T, b.T, e.T


def marginals(m: dict, word: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """P(toxic) of every token; rows are texts, padded with shape -1."""
    live = shape >= 0
    f, b, _ = _forward_backward(_scores(m, word, shape), live, m["trans"])
    x = f * b
    return np.where(live, x / (1 + x), 0.0)


def _train(windows: list, size: int) -> dict:
    width = 2 * RADIUS + 1
    n = len(windows)
    word, shape, y = np.zeros((n, width), np.int32), np.full((n, width), -1, np.int8), np.zeros((n, width))
    for i, (w, s, t) in enumerate(windows):
        word[i, :len(w)], shape[i, :len(w)], y[i, :len(w)] = w, s, t
    live = shape >= 0
    m = {"word": np.zeros(size + 1), "before": np.zeros(size + 1), "after": np.zeros(size + 1),
         "shape": np.zeros(4), "bias": np.zeros(1), "trans": np.zeros((2, 2))}
    before, after = _neighbours(word)
    pair = live[:, 1:]
    seen = np.array([[((1 - y[:, :-1]) * (1 - y[:, 1:]))[pair].sum(), ((1 - y[:, :-1]) * y[:, 1:])[pair].sum()],
                     [(y[:, :-1] * (1 - y[:, 1:]))[pair].sum(), (y[:, :-1] * y[:, 1:])[pair].sum()]])
    first = {k: np.zeros_like(v) for k, v in m.items()}
    second = {k: np.zeros_like(v) for k, v in m.items()}
    tokens = max(int(live.sum()), 1)
    for step in range(1, _STEPS + 1):
        f, b, e = _forward_backward(_scores(m, word, shape), live, m["trans"])
        p = np.where(live, f * b / (1 + f * b), 0.0)
        t = np.exp(m["trans"])
        x = e[:, 1:] * b[:, 1:]
        cells = np.stack([np.full_like(x, t[0, 0]), t[0, 1] * x, f[:, :-1] * t[1, 0], f[:, :-1] * t[1, 1] * x])
        cells = (cells / cells.sum(0))[:, pair].sum(1).reshape(2, 2)
        miss = np.where(live, y - p, 0.0)
        g = {"word": np.bincount(word.ravel(), miss.ravel(), size + 1),
             "before": np.bincount(before.ravel(), miss.ravel(), size + 1),
             "after": np.bincount(after.ravel(), miss.ravel(), size + 1),
             "shape": np.bincount(shape.ravel() & 3, miss.ravel(), 4), "bias": np.array([miss.sum()]), "trans": seen - cells}
        for k in m:
            grad = g[k] / tokens * 100 - 1e-4 * m[k]
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.99 * second[k] + 0.01 * grad * grad
            m[k] = m[k] + 0.25 * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)
        m["before"][0] = m["after"][0] = 0.0      # an unknown neighbour says nothing
    return m


def _tagged(texts: list, m: dict, ids: Ids) -> Iterator[tuple[int, np.ndarray]]:
    """(place, marginals) of every text; texts of like length share a padded block of bounded size."""
    feats = [_features(t, ids) for t in texts]
    order = sorted(range(len(feats)), key=lambda i: len(feats[i][0]))
    i = 0
    while i < len(order):
        j = i + 1
        while j < len(order) and (j + 1 - i) * max(len(feats[order[j]][0]), 1) <= _CELLS:
            j += 1
        part = order[i:j]
        width = max(max(len(feats[k][0]) for k in part), 1)
        word, shape = np.zeros((len(part), width), np.int32), np.full((len(part), width), -1, np.int8)
        for r, k in enumerate(part):
            word[r, :len(feats[k][0])], shape[r, :len(feats[k][0])] = feats[k]
        p = marginals(m, word, shape)
        for r, k in enumerate(part):
            yield k, p[r, :len(feats[k][0])]
        i = j


def _summary(p: np.ndarray) -> tuple[float, float]:
    if not len(p):
        return -1.2, 0.0
    top = min(max(float(p.max()), 6.2e-6), 1 - 6.2e-6)
    return float(np.log(top / (1 - top))) / 10.0, float(np.log1p(p[p >= 0.5].sum()))


def _spans(text: str, p: np.ndarray) -> str:
    """start:end of runs of toxic tokens, in code points, comma-joined."""
    if not len(p) or p.max() < 0.5:
        return ""
    out: list[list[int]] = []
    last = -2
    for i, t in enumerate(_TOKEN.finditer(text)):
        if p[i] >= 0.5:
            if last == i - 1:
                out[-1][1] = t.end()
            else:
                out.append([t.start(), t.end()])
            last = i
    return ",".join(f"{a}:{b}" for a, b in out)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", mod: int = 4, held_out: int = 2) -> dict:
    """The model: word ids, field and curve; a few hundred KB at most."""
    sample = labelled_sample(docs, labels, label, mod, held_out, PER_CLASS)
    toxic, known = _lexicon(sample)
    ids = {w: i + 1 for i, w in enumerate(known)}
    rows = sample.mapInPandas(_training_windows(toxic, ids), "word array<int>, shape array<int>, y array<int>").collect() \
        if toxic else []
    field = _train([tuple(r) for r in rows], len(known))
    if not toxic:
        field["bias"][:] = -12.0

    def summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = Ids(ids)
        for batch in batches:
            out = [(float(batch["label"].iloc[k]), *_summary(p)) for k, p in _tagged(list(batch["text"]), field, table)]
            yield pd.DataFrame(out, columns=["y", "top", "mass"])

    points = np.array([tuple(r) for r in sample.mapInPandas(summaries, "y double, top double, mass double").collect()]) \
        .reshape(-1, 3)
    y = points[:, 0]
    weight, share = class_weights(y, labels, label, mod, held_out)
    curve = [0.0, 0.0, float(np.log(share / (1 - share)))]
    if 0 < y.sum() < len(y):
        curve = fit_logistic(np.column_stack([points[:, 1:], np.ones(len(y))]), y, weight, 1e-4).tolist()
    return {"ids": ids, "field": field, "curve": curve, "toxic": toxic}


def tag(docs: DataFrame, model: dict, score: str = "score", spans: str = "spans") -> DataFrame:
    """``docs`` with the document's probability of being toxic and its toxic spans (start:end, code points)."""
    schema = StructType([f for f in docs.schema if f.name not in (score, spans)]).add(score, DoubleType()).add(spans, StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # only some texts at a time become Python strings; the other columns pass as they are
        curve, table = np.array(model["curve"]), Ids(model["ids"])
        for whole in batches:
            for start in range(0, whole.num_rows, _TEXTS):
                batch = whole.slice(start, _TEXTS)
                texts = batch.column("text").to_pylist()
                points, found = np.zeros((len(texts), 2)), [""] * len(texts)
                for k, p in _tagged(texts, model["field"], table):
                    points[k] = _summary(p)
                    found[k] = _spans(texts[k] or "", p)
                z = np.clip(points @ curve[:2] + curve[2], -30, 30)
                new = {score: pa.array(1 / (1 + np.exp(-z))), spans: pa.array(found, pa.string())}
                yield pa.RecordBatch.from_arrays([new[n] if n in new else batch.column(n) for n in schema.names], names=schema.names)
            give_back()

    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, mod: int = 4, held_out: int = 2, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted, spans) of every row of ``docs``."""
    model = fit(docs, labels, "toxic", mod, held_out)
    return tag(docs.select("doc_id", "text"), model).select(
        "doc_id", (crc_mod(F.col("doc_id"), mod) == held_out).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``docs`` without the rows scored as toxic; same columns, whatever their names."""
    model = fit(docs, labels)
    score, spans = "_toxic_score", "_toxic_spans"
    while score in docs.columns or spans in docs.columns:
        score, spans = "_" + score, "_" + spans
    return tag(docs, model, score, spans).where(F.col(score) < threshold).drop(score, spans)
