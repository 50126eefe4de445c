"""Small fixtures: nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from docmart.llm import decontam, fingerprints, jaccard, license_scan, mixing, quality, secrets, toxicity, url_rules
from docmart.llm.common import drop_stored, stored
from tests.llm.brute import components, shingles, words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, label int"
BASE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"


def texts():
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(6000))
    return [(1, BASE), (2, BASE), (3, BASE + " phi"), (4, None), (5, ""), (6, "one two"), (7, "one two"), (8, long),
            (9, long + " end"), (10, "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" é " + BASE),
            (11, "Released under the MIT License. " + long), (11, "Released under the MIT License. " + long), (None, "stray text here")]


@pytest.fixture()
def docs(spark):
    rows = [(i, t, None, "a" if (i or 0) % 2 else None, len(t or ""), 0.5, 1) for i, t in texts()]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture()
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_jaccard_groups_match_brute_force(docs, none):
    named = {i: t for i, t in texts() if i is not None}
    want = components(list(named.items()), 3, 90)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_groups(docs, 3, 90).collect()}
    assert got.pop(None)[1] is None
    assert got == want
    assert jaccard.jaccard_groups(none).count() == 0


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80)])
def test_jaccard_links_among_texts_that_share_a_passage(spark, k, percent):
    """More prefixes than COMMON hold the passage's tokens; near copies of every kind still link."""
    passage = " ".join(f"shared{i}" for i in range(60))
    rows = [(i, " ".join(f"own{i}x{j}" for j in range(20 + i)) + " " + passage) for i in range(60)]
    rows += [(100 + i, t + " more") for i, t in rows[::3]]                    # near copies of some
    rows += [(200 + i, passage + f" tail{i}") for i in range(40)]             # nothing but the passage and a word
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_groups(
        spark.createDataFrame(rows, "doc_id long, text string"), k, percent).collect()}
    assert got == components(rows, k, percent)
    assert got[239][1] == 200 and got[103][1] == 3 and got[1][1] == 1


def test_one_of_each_group_stays(spark, docs, none):
    kept = jaccard.one_of_each_group(docs)
    assert kept.schema == docs.schema
    known = [(i, t) for i, t in texts() if i is not None]
    want = sorted(i for i, (_, c) in components(known, 5, 80).items() if i == c)
    got = kept.collect()
    assert sorted(r["doc_id"] for r in got if r["doc_id"] is not None) == want     # 11 is there twice, and stays once
    assert [r["text"] for r in got if r["doc_id"] is None] == ["stray text here"]
    assert {r["doc_id"]: r["text"] for r in got if r["doc_id"] is not None} == {i: t for i, t in known if i in want}
    assert jaccard.one_of_each_group(none).count() == 0


def test_stored_tables_are_deleted_and_no_others(spark, docs, scratch):
    table = stored(docs, "spent")
    drop_stored(table)
    with pytest.raises(Exception):
        spark.read.parquet(table.inputFiles()[0].rsplit("/", 1)[0]).count()
    docs.write.parquet(f"{scratch}/kept")
    with pytest.raises(ValueError):
        drop_stored(spark.read.parquet(f"{scratch}/kept"))


def test_jaccard_links_are_all_found(spark):
    base = [f"t{i}" for i in range(60)]
    rows = [(i, " ".join([*base, f"end{i}"])) for i in range(12)]                 # all link with all
    rows += [(20, rows[3][1]), (21, rows[3][1] + " x y z"), (30, "nothing alike here at all"), (31, ""), (32, None)]
    sets = [(i, shingles(t, 3)) for i, t in rows]
    want = {(i, j) for i, x in sets for j, y in sets if i < j and x and y and 100 * len(x & y) >= 90 * len(x | y)}
    links, member = jaccard.jaccard_links(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90)
    rep = {r["doc_id"]: r["rep"] for r in member.collect()}
    pairs = {(r["a"], r["b"]) for r in links.collect()}
    assert {(i, j) for i in rep for j in rep if i < j and (
        rep[i] == rep[j] or tuple(sorted((rep[i], rep[j]))) in pairs)} == want
    assert len(pairs) > 66


def test_fingerprints_of_edited_texts(docs, none):
    rows = fingerprints.edited_fingerprints(docs).collect()
    assert len(rows) == len(texts())
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["fingerprint"] == by[2]["fingerprint"] and by[1]["near_next"] == 1.0
    assert by[4]["fingerprint"] == "" and by[4]["n_chars"] == 0
    t, n = BASE, len(BASE)
    edited = t[: n - n // 4] + BASE[: n // 4]
    assert by[1]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    last = texts()[10][1]
    wrapped = last[: len(last) - len(last) // 4] + BASE[: len(last) // 4]
    assert by[11]["edited_sha256"] == hashlib.sha256(wrapped.encode()).hexdigest()
    assert fingerprints.edited_fingerprints(none).count() == 0


def test_mix_sizes_targets_and_copies(docs, none):
    rows = mixing.mix(docs).collect()
    assert sorted(r["size"] for r in rows) == sorted(len(words(t)) for _, t in texts())
    assert sum({r["source"]: r["target"] for r in rows}.values()) == pytest.approx(sum(r["size"] for r in rows))
    assert all(r["taken"] <= 3 * r["size"] and r["target"] <= 3 * r["source_size"] + 1e-6 for r in rows)
    assert mixing.mix(none).count() == 0


def test_mix_passes_over_documents_that_do_not_fit(spark):
    """A text longer than its source's rest costs the source nothing; longer texts are sampled more often."""
    sizes = [("a", 5000), *[("a", 40 + i % 7) for i in range(200)], ("b", 30000), *[("b", 25) for _ in range(100)],
             *[("c", 10 if i % 2 else 160) for i in range(800)]]
    rows = [(i, " ".join(["w"] * n), s) for i, (s, n) in enumerate(sizes)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for s in "abc":
        mine = [r for r in got if r["source"] == s]
        shortest = min(r["size"] for r in mine)
        rest = [r for r in mine if r["copies"] == min(x["copies"] for x in mine)]
        if s == "b":        # 100 small texts cannot make up for the long one
            assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= max(r["size"] for r in rest)
        else:
            assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= shortest
    drawn = {n: sum(r["copies"] > 0 for r in got if r["source"] == "c" and r["size"] == n) for n in (10, 160)}
    assert drawn[160] > 1.5 * drawn[10] > 0
    again = mixing.mix(spark.createDataFrame(rows[::-1], "doc_id long, text string, source string")).collect()
    assert {(r["doc_id"], r["copies"]) for r in again} == {(r["doc_id"], r["copies"]) for r in got}


def test_random_keys_of_every_encoding_are_found(spark):
    rng = random.Random(5)
    alphabets = {"hex": "0123456789ABCDEF", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
                 "base36": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"}
    keys = [(k, "".join(rng.choices(a, k=n))) for k, a in alphabets.items() for n in (32, 40, 64) for _ in range(60)]
    rows = [(i, f"a key ~{s}~ here") for i, (_, s) in enumerate(keys)]
    rows += [(1000 + i, f"a word {w} here") for i, w in enumerate(["AAAAAAAAAAAAAAAAAAAAAAAA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "=" * 40])]
    got = {r["doc_id"]: r["spans"] for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for kind in alphabets:
        mine = [i for i, (k, _) in enumerate(keys) if k == kind]
        assert sum(f"random:7:{7 + len(keys[i][1])}" in got[i] for i in mine) >= 0.9 * len(mine), kind
    assert not any(got[i] for i in got if i >= 1000)


def test_secrets_are_found_and_masked(docs, none):
    by = {r["doc_id"]: r for r in secrets.scan(docs).collect()}
    assert (by[10]["n_assign"], by[10]["n_access"], by[10]["n_hex"]) == (1, 0, 1)
    assert by[4]["spans"] == "" and by[10]["spans"].startswith("assign:0:49,hex:9:49")
    clean = {r["doc_id"]: r for r in secrets.redact(docs).collect()}
    assert clean[10]["text"] == "[SECRET]\" é " + BASE and clean[10]["n_chars"] == len(clean[10]["text"])
    assert clean[4]["text"] is None and secrets.redact(docs).columns == docs.columns
    assert secrets.scan(none).count() == 0


def test_reparameterised_items_leak(spark, docs, none):
    items = spark.createDataFrame([(1, "A train leaves London at 40 km with 12 carriages and later meets 40 other trains on track"),
                                   (2, None), (None, "x y z")], "item_id long, text string")
    ask = "Hello there. A train leaves Madrid at 70 km with 15 carriages and later meets {} other trains on track. Bye"
    rows = [(1, ask.format(70)), (2, "nothing of the kind"), (3, None), (4, "A train leaves")]
    table = spark.createDataFrame([(i, t, None, None, 0, 0.0, 0) for i, t in rows], SCHEMA)
    assert [(r["doc_id"], r["item_id"], r["verbatim"]) for r in decontam.leaks(table, items).collect()] == [(1, 1, False)]
    assert sorted(r["doc_id"] for r in decontam.clean(table, items).collect()) == [2, 3, 4]
    assert decontam.leaks(none, items).count() == 0


def test_licenses(docs, none):
    assert [(r["doc_id"], r["license"], r["containment"]) for r in license_scan.scan(docs).collect()] == [(11, "MIT line", 1.0)]
    assert license_scan.scan(none).count() == 0


def test_items_of_placeholders_and_longer_names_leak(spark):
    ask = ("On Monday {0} gave nine apples to the teacher and then {0} took four pears from the basket while {1} was "
           "watching the birds near the river and at last {0} asked how many of the fruits {1} had left over")
    items = [(1, "What is 12 + 15 * 3 - 4?"), (2, "They said 12 14 17 19 23 29 31 37 41 43"), (3, ask.format("Mary", "Tom"))]
    rows = [(1, "So. What is 12 + 15 * 3 - 4? Well."), (2, "So. What is 13 + 15 * 3 - 4? Well."),
            (3, "Figures: they had 12 14 17 19 23 29 31 37 41 43 in all."), (4, ask.format("John Smith", "Anna Lee Jones")),
            (5, "On Monday Mary gave nothing at all to John Smith and nobody asked"),
            (6, "The sum 12 + 15 * 3 is known")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["verbatim"]) for r in decontam.leaks(docs, table).collect()}
    assert got == {(1, 1, True), (2, 1, False), (3, 2, True), (4, 3, False)}


def test_matches_add_up_over_neighbouring_shifts(spark):
    words = [f"word{i}" for i in range(48)]
    moved = [*words[:16], "very", *words[16:32], "very", *words[32:]]             # 9 windows stay whole in each part
    docs = spark.createDataFrame([(1, " ".join(moved)), (2, " ".join(words[:16]))], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    assert [(r["doc_id"], r["windows"], r["item_windows"]) for r in decontam.leaks(docs, items).collect()] == [(1, 27, 41)]


def test_every_license_is_found_by_its_wording(spark):
    filler = " ".join(f"w{i}" for i in range(40))
    rows = [(name, f"{filler}. {text}. {filler}") for name, text in license_scan.LICENSES.items()]
    rows += [("line", f"{filler}.\nAll rights reserved.\n{filler}"), ("owner", "Copyright 2021 Acme. All rights reserved."), ("bare", filler)]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    found = {(r["doc_id"], r["license"]): r["containment"] for r in got}
    assert all(found.get((name, name)) == 1.0 for name in license_scan.LICENSES)
    assert found["line", "All rights reserved"] == found["owner", "All rights reserved"] == 1.0
    assert not [k for k in found if k[0] == "bare"]


def test_licenses_at_exactly_the_least_containment(spark):
    notices = {"five": "Licensed under CC BY-NC 4.0", "ten": "alphabet beta gamma delta epsilon zeta eta theta iota kappa lambda mutable"}
    rows = [(1, "Available under CC BY-NC 4.0"), (2, "beta gamma delta epsilon zeta eta theta iota kappa lambda"),
            (3, "under one CC BY-NC 4.0"), (4, "gamma delta epsilon zeta eta theta iota kappa lambda")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["license"], r["containment"]) for r in license_scan.scan(docs, notices).collect()}
    assert got == {(1, "five", 0.8), (2, "ten", 0.8)}


def test_url_rules(spark):
    urls = {1: "http://a.net/x", 2: "https://m.EXAMPLE.net/en/1", 3: "http://example.com/de/", 4: "http://x.org/fr/a?b",
            5: "http://spam-farm.example.org/en/", 6: None, 7: "no scheme", 8: "http://a.net", 9: "http://a.net/x"}
    table = spark.createDataFrame([(i, u, "h") for i, u in urls.items()], "page_id long, url string, html string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_rules.judge(table).collect()}
    assert got[1] == got[9] == ("a.net", "/x", "net/", "block") and got[2] == ("m.example.net", "/en/1", "example.net/en/", "allow")
    assert got[3][2:] == ("example.com/de/", "block") and got[4][2:] == ("org/fr/", "allow")
    assert got[5][2:] == (None, "block") and got[6] == ("", "", None, "allow") and got[8] == ("a.net", "", None, "allow")


def test_url_rules_with_capitals_in_the_path(spark):
    rules = (url_rules.host_rule("block", "org", "/enUS/"), url_rules.host_rule("allow", "a.org", "/enUS/Ok"))
    urls = ["http://a.org/enUS/x", "http://a.org/enus/x", "http://b.org/enUS/", "http://a.org/enUS/Okay", "http://a.org/enUS/ok",
            "http://b.org/" + "long/" * 5000 + "enUS/"]
    table = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_rules.judge(table, rules).collect()}
    assert got == {0: ("org/enUS/", "block"), 1: (None, "allow"), 2: ("org/enUS/", "block"), 3: ("a.org/enUS/Ok", "allow"),
                   4: ("org/enUS/", "block"), 5: (None, "allow")}
    empty = spark.createDataFrame([], "page_id long, url string, rule int, verdict int, token string")
    assert url_rules.judge(empty, rules).count() == 0


def test_classifiers(spark, docs, none):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(400)] + [(None, 1, 1), (3, None, None)],
                                   "doc_id long, quality int, toxic int")
    rows = [(i, (f"{BASE} w{i} idiot {BASE}" if i % 2 else f"*** ### {i} ### *** $$$ %%% ") * 3, None, None, 0, 0.0, 0)
            for i in range(400)] + [(500, None, None, None, 0, 0.0, 0), (None, "", None, None, 0, 0.0, 0)]
    table = spark.createDataFrame(rows, SCHEMA)
    for got in (quality.quality(table, labels), toxicity.toxicity(table, labels)):
        got = got.where("doc_id < 400").collect()
        assert len(got) == 400 and sum(r["predicted"] == r["doc_id"] % 2 for r in got) >= 396
        assert all(0 <= r["score"] <= 1 for r in got)
    assert quality.quality(none, labels).count() == 0 and toxicity.toxicity(docs, labels.limit(0)).count() == len(texts())
    kept = toxicity.without_toxic(table, labels)
    assert kept.columns == table.columns and kept.where("doc_id % 2 = 0").count() == 201


def test_gru_scores_match_counts(spark):
    from collections import Counter
    from math import log10
    from zlib import crc32

    from docmart.llm import gru_lm
    rows = [(i, f"{BASE} rare{i} The the") for i in range(60)] + [(100, None)]
    got = {r["doc_id"]: r for r in gru_lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    train = [t for i, t in rows if crc32(str(i).encode()) % 7 != 2]
    c = Counter(w for t in train for w in [*words(t), None])
    n, v = sum(c.values()), len(c)
    for i, t in rows:
        tokens = [*words(t), None]
        assert got[i]["n_tokens"] == len(tokens) and got[i]["train_tokens"] == n
        assert got[i]["n_known"] == sum(c[w] > 0 for w in tokens)
        assert got[i]["base_score"] == pytest.approx(sum(log10((c[w] + 1) / (n + v + 1)) for w in tokens))
        assert got[i]["score"] < 0


def test_gru_trains_on_whole_texts_and_its_words_grow():
    import numpy as np
    import pandas as pd

    from docmart.llm import gru_lm
    texts = [" ".join(f"w{(i + j) % 50}" for j in range(n)) for i, n in enumerate([5, 400, 1, 0, 97])]
    common = [(f"w{i}".encode(), 60 - i) for i in range(50)]
    first = gru_lm._first(np.ones(gru_lm.WORDS + 2))
    got = pd.concat(gru_lm._trainer(first, common)([pd.DataFrame({"seed": range(5), "text": texts})]))
    assert set(got["tokens"]) == {sum(len(t.split()) + 1 for t in texts)}
    assert gru_lm.vocabulary(4_000_000) == 8000 and gru_lm.vocabulary(10) == gru_lm.WORDS


def test_gru_gradients_match_differences_and_the_scorer():
    import numpy as np

    from docmart.llm import gru_lm
    rng = np.random.default_rng(1)
    m = {k: v.astype(np.float64) for k, v in gru_lm._first(rng.integers(1, 90, 5000)).items()}
    ids = np.append(rng.integers(1, 5000, 11), gru_lm.END).astype(np.int32)
    x, y, h = np.append(gru_lm.END, ids[:-1])[:, None], ids[:, None], np.zeros((1, gru_lm.HIDDEN))
    loss, g, _ = gru_lm.window_gradients(m, x, y, np.ones_like(y, bool), h)
    assert loss == pytest.approx(-gru_lm.log_probabilities(m, [ids])[0], rel=1e-4)
    for k in m:
        rows, d = g[k]
        dense = np.zeros_like(m[k])
        dense[rows] = d
        at = np.unravel_index(np.abs(dense).argmax(), dense.shape)
        near = []
        for e in (1e-5, -1e-5):
            moved = {**m, k: m[k].copy()}
            moved[k][at] += e
            near.append(gru_lm.window_gradients(moved, x, y, np.ones_like(y, bool), h)[0])
        assert (near[0] - near[1]) / 2e-5 == pytest.approx(dense[at], rel=1e-2)
