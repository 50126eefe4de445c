"""Sets kept by counts equal a full rebuild after inserts, repeats and removals."""

import random
from collections import Counter

import pytest

from docmart.operators.counted_sets import CountedSets, signed

SCHEMA = "genre_id string, film_work_id string"


def links(spark, pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def write(spark, store, batch, come=(), go=()):
    rows = signed(links(spark, come), "genre_id").unionByName(signed(links(spark, go), "genre_id", -1))
    store.append(rows, batch)


def sets(store):
    return {(r["id"], r["film_id"]): r["n"] for r in store.entries().collect()}


@pytest.fixture()
def store(spark, scratch):
    return CountedSets(spark, f"{scratch}/counted", files=4)


def test_random_batches_equal_a_rebuild(spark, store, scratch):
    rng = random.Random(3)
    state = Counter()
    for batch in range(3):
        # one genre holds most links; the same link comes more than once
        come = [("hot" if rng.random() < 0.6 else f"g{rng.randrange(9)}", f"f{rng.randrange(40)}") for _ in range(150)]
        go = rng.sample(sorted(state.elements()), min(60, state.total()))
        before = {k for k, n in state.items() if n > 0}
        state.update(come)
        state.subtract(go)
        after = {k for k, n in state.items() if n > 0}
        write(spark, store, batch, come, go)
        got = {(r["id"], r["film_id"]): r["change"] for r in store.changes(batch).collect()}
        assert got == {**{k: "added" for k in after - before}, **{k: "retracted" for k in before - after}}
    want = {k: n for k, n in state.items() if n > 0}
    assert sets(store) == want and store.unmatched().count() == 0
    whole = store.parts(3).collect()
    assert sorted((r["id"], f) for r in whole for f in r["film_ids"]) == sorted(want)
    by_part = {(r["id"], r["part"]): r["film_ids"] for r in whole}
    for r in store.parts(3, changed_in=2).collect():
        assert r["film_ids"] == by_part.get((r["id"], r["part"]), [])
    small = store.compacted(f"{scratch}/small", 1)
    assert sets(small) == want
    assert small.changes(2).exceptAll(store.changes(2)).count() == 0 == store.changes(2).exceptAll(small.changes(2)).count()


def test_replays_repeats_nulls_and_the_last_entry(spark, store):
    write(spark, store, 0, [("a", "1"), ("a", "1"), ("b", "2"), (None, "3"), ("c", None)])
    assert sets(store) == {("a", "1"): 2, ("b", "2"): 1}
    for _ in range(2):                                       # a replayed batch counts once
        write(spark, store, 1, go=[("a", "1"), ("b", "2")])
    assert sets(store) == {("a", "1"): 1}
    assert [tuple(r) for r in store.changes(1).collect()] == [("b", "2", "retracted")]
    assert [(r["id"], r["film_ids"]) for r in store.parts(4, changed_in=1).collect()] == [("b", [])]
    write(spark, store, 2, [], [("b", "2")])                 # gone twice
    assert [tuple(r) for r in store.unmatched().collect()] == [("b", "2", -1)] and store.changes(2).count() == 0


def test_empty_batch(spark, store):
    write(spark, store, 0)
    assert sets(store) == {} and store.changes(0).count() == 0
