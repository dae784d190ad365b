"""Models of op7 come from all examples of the input, however these are dealt."""

import random

import numpy as np

from tidelog.llm import pii


def test_all_examples_are_fitted(spark):
    rng = random.Random(4)
    texts = [f"please write to n{i}.{rng.randrange(10**6)}@h{rng.randrange(10**6)}.example.org today" for i in range(1500)]
    docs = spark.createDataFrame([*enumerate(texts), *enumerate(texts[:50])], "doc_id bigint, text string")
    made = [(kind, label) for t in texts for kind, b, e, good in pii.candidates(t) if good for label, _ in pii.loose_examples(t, kind, b, e, 0)]
    models = pii.train(docs.repartition(2))
    assert models["email"].examples >= 0.99 * len(made) > 9000  # less equal bins in equal surroundings; a sample had 4000 of a label
    again = pii.train(docs.repartition(7))["email"]
    assert (again.threshold, again.slope, again.examples) == (models["email"].threshold, models["email"].slope, models["email"].examples)
    x = np.array([pii.features("write to bob (at) example (dot) com now", 9, 35)])
    assert again.score(x) == models["email"].score(x)
