"""Filter audit, embedding near-duplicates and spelling variants against brute force, on small fixtures."""

import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from docmart.llm import embedding_dedup, filter_audit, spelling

DOCS = "doc_id long, text string, source string, part string, word string, n int"


# ---- filter audit -------------------------------------------------------------------


def audit_rows():
    varied = " ".join(f"w{i}" for i in range(220))
    dull = "same words " * 120
    return [(1, varied, "a"), (2, varied, "a"), (3, varied + " #", "b"), (4, None, None), (5, "", "a"), (6, "", ""),
            (7, dull, "a"), (8, dull, None), (9, "SHOUTED TEXT", "b"), (10, "SHOUTED TEXT", "b"), (10, "SHOUTED TEXT", "b"),
            (11, varied * 40, "b"), (12, dull.upper() + " 5%", "a"), (None, varied, "a"), (None, "stray", "b"), (0, dull, "b")]


def audit_by_hand(rows, labels):
    smallest = {}
    for i, t, _ in rows:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    parts = {}
    for i, t, s in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and smallest[t] < i}
        parts.setdefault(s or "", []).append((i, {f for f, bad in fails.items() if bad}))
    out, shapley = {}, Counter()
    for part, docs in parts.items():
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                failing = [d for d in docs if f in d[1]]
                shapley[part, f] += len(gone)
                out[part, order, step] = [len(left), len(gone),
                                          len([d for d in failing if d not in gone]),
                                          len([d for d in docs if d[1] == {f}]),
                                          len([d for d in gone if d[0] in good]), len([d for d in gone if d[0] in toxic])]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_equals_filters_applied_one_after_the_other(spark):
    rows = audit_rows()
    labels = [(1, 1, 0), (7, 0, 1), (8, 1, 1), (10, None, 1), (10, 1, None), (99, 1, 1), (None, 1, 1)]
    docs = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], DOCS)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in filter_audit.audit(docs, marks).collect()}
    assert got == audit_by_hand(rows, labels)
    assert len(got) == 3 * 600


def test_audit_of_nothing(spark):
    docs = spark.createDataFrame([], DOCS)
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, marks).count() == 0


def test_removal_steps_are_the_first_failing_place():
    orders, _, step = filter_audit.removal_steps()
    for pattern in range(32):
        for j, order in enumerate(orders):
            places = [order.index(f) + 1 for b, f in enumerate("ABCDE") if pattern >> b & 1]
            assert step[pattern, j] == min(places, default=np.inf)


# ---- embeddings ---------------------------------------------------------------------


def vectors():
    rng = np.random.default_rng(5)
    rows, i = [], 0

    def add(label, v):
        nonlocal i
        rows.append((i, None if v is None else [None if x is None else float(x) for x in v], label))
        i += 1

    for label in (0, 1, 2):
        for _ in range(60):
            add(label, rng.standard_normal(24))
        for size, noise in ((40, 0.04), (5, 0.06)):
            centre = rng.standard_normal(24)
            for _ in range(size):
                add(label, centre + noise * rng.standard_normal(24))
    copy = rows[3][1]
    for label in (0, 0, 1, None):
        add(label, copy)
    add(0, [2 * x for x in copy])
    for odd in (None, [], [0.0] * 24, [None, *copy[1:]], [float("nan"), *copy[1:]], [float("inf"), *copy[1:]], copy[:23],
                [x * 1e30 for x in copy]):
        add(0, odd)
    rows.append((3, copy, 0))                          # a repeated row
    rows.append((7, rows[70][1], rows[70][2]))         # an id with two vectors
    rows.append((None, copy, 0))
    return rows


def linked_by_hand(rows, threshold):
    unit = []
    for i, v, label in rows:
        ok = i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        x = np.array(v, float) if ok else None
        unit.append(x / np.abs(x).max() if ok else None)
        if ok:
            unit[-1] /= np.linalg.norm(unit[-1])
    n_links, parent = [0] * len(rows), {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(len(rows)):
            if a != b and unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2] \
                    and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                n_links[a] += 1
                p, q = sorted((find(rows[a][0]), find(rows[b][0])))
                parent[q] = p
    return sorted((str(r[0]), n, str(find(r[0])), r[0] is not None and r[0] == find(r[0])) for r, n in zip(rows, n_links))


@pytest.mark.parametrize("block", [4096, 7])
def test_embeddings_equal_all_pairs(spark, monkeypatch, block):
    """The planted copies are far above the threshold, so every pair is found; also when cells are cut into blocks."""
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("n", F.lit("x")) \
        .withColumn("cell", F.lit(1))
    rows = [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()]     # as float32
    got = sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"])
                 for r in embedding_dedup.near_duplicates(df).collect())
    assert got == linked_by_hand(rows, 0.93)


def test_recall_at_the_threshold():
    """Pairs whose cosine is just above the threshold meet in some table."""
    rng = np.random.default_rng(9)
    x = rng.standard_normal((3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.standard_normal((3000, 64))
    y -= (x * y).sum(1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near = 0.931 * x + np.sqrt(1 - 0.931 ** 2) * y
    a, b = embedding_dedup.codes_of(x), embedding_dedup.codes_of(near)
    apart = sum(np.bitwise_count(p ^ q) for p, q in zip(a, b))
    met = (embedding_dedup.first_shared(a, b) < embedding_dedup.TABLES) & (apart <= embedding_dedup.SLACK)
    assert met.mean() > 0.96


def test_embeddings_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(empty).count() == 0


# ---- spelling -----------------------------------------------------------------------


def near_by_hand(words):
    known, out = set(words), set()
    letters = {c for w in words for c in w}
    for w in known:
        made = {w[:i] + w[i + 1:] for i in range(len(w))}
        made |= {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters}
        made |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        out |= {(w, m) for m in made & known if m != w}
    return out


def spelled():
    rng = np.random.default_rng(3)
    words = {"".join(rng.choice(list("abé"), rng.integers(5, 11))) for _ in range(900)}
    words |= {"a" * n for n in range(1, 30)} | {"a" * n + "b" for n in range(3, 12)}
    words |= {"x" * 3000, "x" * 3001, "x" * 2999 + "y", "x" * 1500 + "y" + "x" * 1500}
    words |= {"common" + "".join(rng.choice(list("abcdefghijk"), 4)) for _ in range(300)}
    words |= {"".join(rng.choice(list("abcdefghijk"), 4)) + "ending" for _ in range(300)}
    return sorted(words)


def test_neighbours_equal_all_single_edits(spark):
    words = spelled()
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = {(r["word"], r["near"]) for r in spelling.neighbours(df).collect()}
    assert got == near_by_hand(words)


def variants_by_hand(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            counts[w[:h % len(w)] + w[h % len(w) + 1:] if h % 31 == 0 else w] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [] for w in counts}
    for a, b in near_by_hand(list(counts)):
        near[a].append(b)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()}


def spelled_texts():
    forms = ["Gemeinde", "gemeinden", "ÉCOLE", "écoliers", "watching", "watchinq", "wwatching", "questions", "question"]
    rows = [(i, " ".join(f"{forms[(i * j) % len(forms)]}." for j in range(1, 40))) for i in range(120)]
    rows += [(500 + i, "rareword rarewords " + "rarewort " * i) for i in range(30)]
    rows += [(900, None), (901, ""), (902, "1 2 3"), (None, "gemeinde gemeinde"), (903, "z" * 5000 + " " + "z" * 5000),
             (904, "ab " * 20000 + "watching"), (905, "gemeinde"), (905, "gemeinde")]
    return rows


def test_variants_equal_brute_force(spark):
    rows = spelled_texts()
    docs = spark.createDataFrame([(i, t, "a", "p", "w", 1) for i, t in rows], DOCS).repartition(5)
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.variants(docs).collect()}
    want = variants_by_hand(rows)
    assert got == want
    assert any(r[0] for r in want.values())


def test_variants_of_nothing(spark):
    assert spelling.variants(spark.createDataFrame([], DOCS)).count() == 0


def test_roots_follow_forms_to_the_end(spark):
    rows = [(f"w{i}", f"w{i + 1}") for i in range(18)] + [("a", "w3")]
    got = {r["word"]: r["root"] for r in spelling.roots(spark.createDataFrame(rows, "word string, form string")).collect()}
    assert got == {w: "w18" for w, _ in rows}
