"""The registered queries of this subpackage: thin digests of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import gru_lm
from .common import read
from .decontam import leaks
from .embedding_dedup import near_duplicates
from .filter_audit import audit
from .fingerprints import edited_fingerprints
from .jaccard import jaccard_groups, jaccard_links
from .license_scan import scan as license_scan
from .mixing import mix
from .oracle import ORACLE_SQL  # noqa: F401
from .quality import quality
from .secrets import scan
from .spelling import variants
from .toxicity import toxicity
from .url_rules import judge


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(read(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"))


def op5_gru_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gru_lm.score(read(spark, sf_dir, "documents"))


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages")).drop("url")


def op7_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(read(spark, sf_dir, "documents"), k=3, percent=90)


def op7_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_links(read(spark, sf_dir, "documents"), k=3, percent=90)[0]


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_fingerprints, op2_decontamination, op3_quality, op4_secrets, op5_gru_scores, op6_url_rules, op7_jaccard_groups,
    op7_jaccard_links, op8_mix,
    op9_license_scan, op10_toxicity, op11_filter_audit, op12_embedding_dedup, op13_spelling_variants)}
