"""Components of n-gram similarity against brute force over all pairs."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidelog.llm import ngram_join

SCHEMA = "doc_id bigint, text string, node bigint, column string, component string, n bigint"


def grams(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 4]) for k in range(max(1, len(words) - 3))} if words else set()


def components(rows):
    sets = [(i, grams(t)) for i, t in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, (i, one) in enumerate(sets):
        for j, two in sets[:x]:
            if i is not None and j is not None and one and two and 100 * len(one & two) >= 85 * len(one | two):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return sorted([(i, len(s), None if i is None else find(i)) for i, s in sets], key=repr)


def found(spark, rows, parts=4):
    frame = spark.createDataFrame([(i, t, 1, "c", "k", 7) for i, t in rows], SCHEMA).repartition(parts)
    return sorted(map(tuple, ngram_join.ngram_components(frame).collect()), key=repr)


def corpus(seed):
    """Families of near copies around the threshold, exact copies, texts that share a passage, and odd texts."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(500)]
    passage = rng.choices(words, k=50)
    texts = []
    for family in range(6):
        base = rng.choices(words, k=rng.choice([12, 60, 150, 300]))
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 30)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            if rng.random() < 0.3:
                copy = copy[: int(len(copy) * rng.uniform(0.8, 1))]
            texts.append(" ".join(copy))
        texts += [texts[-1]] * 3
    for _ in range(25):
        own = rng.choices(words, k=rng.choice([20, 80]))
        texts.append(" ".join(own[:10] + passage + own[10:]))
    texts += ["", None, "  \n", "One", "one", "two words", "a b c d", "A B C D", "x" * 40_000, " ".join(rng.choices(words, k=9000))]
    texts.append(texts[-1] + " end")
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rows = corpus(seed)
    assert found(spark, rows) == components(rows)


def test_repeated_and_missing_ids(spark):
    one, two, three = ("alpha beta gamma delta epsilon", "one two three four five six", "some other text of seven words here")
    rows = [(5, one), (5, two), (5, one), (9, two), (2, one), (7, three), (None, one), (None, None), (11, None), (11, three)]
    assert found(spark, rows) == components(rows)


def test_no_documents(spark):
    frame = ngram_join.ngram_components(spark.createDataFrame([], SCHEMA))
    assert frame.columns == ["doc_id", "n_shingles", "component_id"] and frame.collect() == []


def test_chain_of_links(spark):
    """Neighbours are linked, ends are not: one component all the same."""
    words = [f"w{k}" for k in range(140)]
    rows = [(100 - i, " ".join(words[4 * i : 4 * i + 80])) for i in range(12)]
    assert found(spark, rows) == components(rows)
    assert {r[2] for r in found(spark, rows)} == {89}


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=60), st.integers(0, 20), st.integers(0, 20), st.randoms())
def test_overlap_over_blocks(both, only_one, only_two, rng):
    values = sorted(both)
    rng.shuffle(values)
    one, two = set(values[only_one:]) or set(values), set(values[: max(1, len(values) - only_two)])
    linked = 100 * len(one & two) >= 85 * len(one | two)
    assert ngram_join.overlap_reaches(np.array(sorted(one)), np.array(sorted(two))) == linked


def test_bounds():
    for n in range(1, 400):
        assert ngram_join.least(n) == -(-85 * n // 100) and 1 <= n - ngram_join.least(n) + ngram_join.wider(n) <= n
        for m in range(1, 400):
            need = ngram_join.enough(n, m)
            assert 100 * need >= 85 * (n + m - need) and 100 * (need - 1) < 85 * (n + m - need + 1)
