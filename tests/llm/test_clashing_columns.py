"""Stages of the pipeline on tables whose columns have names like those that operators use inside, and on map columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidelog.llm import mixing, near_duplicates, quality_rules

NAMES = ["_dropped", "_again", "_no", "_rejected", "_kept", "_id", "row", "best", "held", "n_tokens", "p_good", "rate", "copies", "doc", "component"]


@pytest.fixture(scope="module")
def docs(spark):
    texts = [" ".join(f"w{i}x{k}" for k in range(30 + i)) for i in range(25)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    rows += [(30, texts[3], "en", "s", 1), (3, texts[3], "en", "s", 1), (3, texts[4], "de", "s", 1), (None, texts[0], None, None, None), (31, None, None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name in NAMES:
        frame = frame.withColumn(name, F.lit(name))
    return frame.withColumn("m", F.create_map(F.lit("k"), F.col("doc_id")))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(25)], "doc_id bigint, quality int, toxic int")


def rows_of(frame):
    return sorted(((r.doc_id, r.text) for r in frame.collect()), key=repr)


def test_quality_rules(docs):
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and rows_of(kept)
    assert rows_of(kept) == rows_of(quality_rules.keep_good(docs.select("doc_id", "text", "lang", "source", "n_chars")))


def test_near_duplicates(docs):
    kept = near_duplicates.deduplicate(docs)
    assert kept.columns == docs.columns
    assert rows_of(kept) == rows_of(near_duplicates.deduplicate(docs.select("doc_id", "text").repartition(3)))
    ids = [i for i, _ in rows_of(kept)]
    assert ids.count(3) == 1 and 30 not in ids and None in ids and 31 in ids


def test_mixing(docs, labels):
    mixed = mixing.mix(docs, labels, thinned="toxic")
    assert mixed.columns == [c for c in docs.columns if c not in ("rate", "copies")] + ["rate", "copies"]
    found = mixed.collect()
    assert {r.doc_id: r._id for r in found}[5] == "_id" and all(r.copies > 0 for r in found)
    assert len({(r.rate, r.copies) for r in found if r.doc_id == 3}) <= 1
    assert [(r.rate, r.copies) for r in found if r.doc_id is None] == [(1.0, 1)]
    rated = {r.doc_id: r.rate for r in mixing.document_rates(docs.where("doc_id <> 3"), labels, mixing.DOMAINS).collect()}
    again = {r.doc_id: r.rate for r in mixing.mix(docs.where("doc_id <> 3"), labels, mixing.DOMAINS).collect()}
    assert all(rated[i] == rate for i, rate in again.items())


def test_stages_keep_the_order_of_columns(spark, docs, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "nothing of the kind")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name
