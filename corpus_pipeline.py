"""The corpus pipeline: quality rules, near-duplicates, benchmark decontamination, personal data, mixing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written and read again as the next one's
``docs``. All stages but the last return the columns of ``documents``; the last one adds ``rate`` and ``copies``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import decontaminate, mixing, near_duplicates, pii, quality_rules
from tidelog.llm.common import stored, table


#: The domain that the mix thins out; its targets follow from what the earlier stages leave of each domain.
THINNED = "toxic"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_duplicates.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the benchmark's words."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced."""
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of a mix without the toxic ones, each with its rate and its number of copies."""
    return mixing.mix(docs, table(spark, sf_dir, "labels"), thinned=THINNED)


STAGES = [
    ("quality rules", quality),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("mixing", mixture),
]

#: SQL cannot express the iterated estimates, trained models and fitted rates of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
