"""Whole texts reach the helpers of tasks a few at a time."""

import pytest
from pyspark.sql import functions as F

from docmart.llm import decontam, jaccard
from docmart.llm.tokens import map_pieces

BIG = 2**53 + 1         # no double


def _sizes(frames):
    for f in frames:
        yield f.assign(n=len(f))


def test_frames_are_small_and_ids_stay_whole(spark):
    ids = spark.range(1201).coalesce(1).select(F.when(F.col("id") != 5, F.col("id") + BIG).alias("doc_id"), F.lit("é x").alias("text"))
    got = map_pieces(ids, _sizes, "doc_id long, text string, n long").collect()
    assert len(got) == 1201 and max(r["n"] for r in got) <= 500 and {r["text"] for r in got} == {"é x"}
    assert {r["doc_id"] for r in got} == {None, *(BIG + i for i in range(1201) if i != 5)}
    assert map_pieces(ids.limit(0), _sizes, "doc_id long, text string, n long").count() == 0


@pytest.mark.parametrize("module, run", [
    (decontam, lambda docs: decontam.leaks(docs, docs.withColumnRenamed("doc_id", "item_id"))),
    (jaccard, lambda docs: jaccard.one_of_each_group(docs))])
def test_no_batch_of_whole_texts_becomes_python_strings_at_once(spark, monkeypatch, capsys, module, run):
    plans, stored = [], module.stored

    def noted(df, name):
        df.explain()
        plans.append(capsys.readouterr().out)
        return stored(df, name)

    monkeypatch.setattr(module, "stored", noted)
    text = " ".join(f"w{i}" for i in range(30))
    run(spark.createDataFrame([(1, text), (2, text + " end"), (3, None)], "doc_id long, text string")).collect()
    assert any("MapInArrow" in p for p in plans) and not any("MapInPandas" in p for p in plans)


def test_pairs_of_large_sets_are_written_to_few_files(spark, monkeypatch):
    files, stored = {}, jaccard.stored

    def noted(df, name):
        out = stored(df, name)
        files.setdefault(name, []).append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(jaccard, "stored", noted)
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = [(2 * i + j, " ".join(f"w{i}x{n}" for n in range(300)) + " end" * j) for i in range(150) for j in (0, 1)]
        got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: i // 2 * 2 for i in range(300)}
    assert files["near"][0] <= 3 and files["linked"][0] <= 3, files
