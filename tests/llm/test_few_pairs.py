"""op10 and its components: small tables of pairs and links are broadcast, large ones shuffled, with the same rows."""

import random

import pytest

from tidelog.llm import components, near_duplicates


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(4000)]
    rows = []
    for group in range(12):
        base = rng.choices(words, k=120)
        for _ in range(rng.choice((1, 2, 6, 9))):
            near = list(base)
            near[rng.randrange(120)] = "other"
            rows.append((len(rows), " ".join(near)))
    rows += [(3, rows[20][1]), (3, rows[20][1]), (None, rows[0][1]), (500, None), (501, "")]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_few_and_many_pairs_give_the_same_rows(docs, monkeypatch):
    few = sorted(map(tuple, near_duplicates.near_duplicates(docs).collect()), key=repr)
    assert len({row[2] for row in few}) < len(few) - 5
    monkeypatch.setattr(near_duplicates, "SENT_PAIRS", -1)
    monkeypatch.setattr(components, "SENT_LINKS", -1)
    assert sorted(map(tuple, near_duplicates.near_duplicates(docs).collect()), key=repr) == few


def test_a_round_over_few_links_joins_without_shuffle(spark):
    edges = spark.range(1000).selectExpr("id + 1 AS a", "id AS b")
    frame = components.small_star(components.large_star(edges, few=True), few=True)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
