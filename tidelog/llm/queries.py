"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import (
    centroid_clusters,
    decontaminate,
    merkle_manifest,
    mixing,
    near_duplicates,
    ngram_join,
    pii,
    quality_model,
    quality_rules,
    revisits,
    secret_scan,
    substring_duplicates,
    token_counts,
)
from tidelog.llm.common import table
from tidelog.llm.oracle import ORACLE  # noqa: F401


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.document_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"))


def op5_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revisits.resolve(revisits.captures_of(table(spark, sf_dir, "pages")))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        decontaminate.digest_items("items").alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.personal_data(table(spark, sf_dir, "documents")))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_duplicates.digests(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.secrets(table(spark, sf_dir, "documents")))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.manifest(table(spark, sf_dir, "documents"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters.clusters(table(spark, sf_dir, "embeddings"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_quality_classifier,
        op3_source_mixing,
        op4_quality_rules,
        op5_revisits,
        op6_decontamination,
        op7_pii,
        op8_substring_dedup,
        op9_secret_scan,
        op10_near_duplicates,
        op11_merkle_manifest,
        op12_centroid_clusters,
        op13_ngram_join,
    )
}
