"""From ``documents`` to a training mix, in five stages.

toxicity -> near duplicates (n-gram Jaccard) -> decontamination -> secrets -> mix.

Every stage works on all rows that the one before kept and is written as
Parquet to the shared folder of the session before the next one reads it.
All but the last return the columns of ``documents``.  Rows with nulls pass
every filter; texts that hold secrets are kept with the secrets masked.
The last stage keeps the documents that the mix takes, with the number of
copies, and the words taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docmart.llm.common import read, stored
from docmart.llm.decontam import clean
from docmart.llm.jaccard import one_of_each_group
from docmart.llm.mixing import mix
from docmart.llm.secrets import redact
from docmart.llm.toxicity import without_toxic


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, read(spark, sf_dir, "labels"))


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each_group(docs, k=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean(docs, read(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs).where("copies > 0").select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", duplicates_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("mix", mix_stage),
]

# a random field, learned thresholds and connected components are not SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
