"""The pipeline's mixing stage with few and with many toxic documents."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidelog.llm import mixing


def documents(toxic):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(200)]
    vile = [f"vile{i}" for i in range(6)]
    out = []
    for i in range(800):
        text = rng.choices(words, k=40)
        if i < toxic:
            text[::10] = rng.sample(vile, 4)
        out.append((i, " ".join(text), "s", int(i < toxic)))
    return out


@pytest.mark.parametrize("toxic", [30, 400])
def test_toxic_documents_go_and_clean_ones_stay(spark, tmp_path, toxic):
    rows = documents(toxic)
    labels = [(i, 1, t) for i, _, _, t in rows if i % 2 == 0]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id bigint, text string, source string")
    mixed = corpus_pipeline.mixture(spark, docs, str(tmp_path)).collect()
    kept = [r.doc_id for r in mixed]
    assert len(kept) == len(set(kept)) and all(r.copies > 0 for r in mixed)
    assert sum(i < toxic for i in kept) <= 0.05 * toxic
    assert sum(i >= toxic for i in kept) >= 0.95 * (800 - toxic)


def test_a_plan_holds_the_word_weights_once(spark):
    model = ([0] * (mixing.BUCKETS - 1) + [1], [0.123456789, 1.5, 2.5])
    means = mixing._evidence(mixing._buckets(F.col("text")), model).alias("means")
    frame = spark.createDataFrame([("a b",)], "text string").select(means)
    assert frame._jdf.queryExecution().optimizedPlan().toString().count("0.123456789") == 1


def test_a_plan_has_no_row_number_of_every_bucket(spark):
    rng = random.Random(2)
    telling = sorted({0, 63, 64, 127, mixing.BUCKETS - 1, *rng.sample(range(mixing.BUCKETS), 600)})
    place = [0] * mixing.BUCKETS
    for row, bucket in enumerate(telling, 1):
        place[bucket] = row
    weights = [rng.uniform(-3, 3) for _ in range(len(telling) * len(mixing.DOMAINS))]
    seen = [rng.sample(telling, 9) + rng.sample(range(mixing.BUCKETS), 300) + [0, 0, 63] for _ in range(20)] + [[], telling, [b for b in range(700) if not place[b]]]
    rows = spark.createDataFrame(list(enumerate(seen)), "i int, buckets array<int>")
    means = rows.select("i", mixing._evidence(F.col("buckets"), (place, weights)).alias("means"))
    for row in means.collect():
        total = [0.0] * len(mixing.DOMAINS)
        for bucket in dict.fromkeys(seen[row.i]):
            if place[bucket]:
                at = (place[bucket] - 1) * len(total)
                total = [t + w for t, w in zip(total, weights[at : at + len(total)])]
        assert row.means == total
    assert len(means._jdf.queryExecution().optimizedPlan().toString()) < 100_000
