"""Documents that share a band by chance cost op10 no sets, and large buckets still lose no link."""

import random

from tidelog.llm import near_duplicates as n


def half_alike(rng, first):
    """Pairs of texts with about 0.4 of their shingles in common: many share a band, none is near."""
    out = []
    for i in range(40):
        words = [f"w{rng.randrange(10**6)}" for _ in range(100)]
        other = words[:58] + [f"v{rng.randrange(10**6)}" for _ in range(42)]
        out += [(first + 2 * i, " ".join(words)), (first + 2 * i + 1, " ".join(other))]
    return out


def test_no_sets_for_chance_buckets(spark, monkeypatch):
    kept = []

    def stored(frame, write=n.stored):
        out = write(frame)
        kept.append(out)
        return out

    monkeypatch.setattr(n, "stored", stored)
    docs = spark.createDataFrame(half_alike(random.Random(5), 0), "doc_id bigint, text string").repartition(3)
    assert all(r.component_id == r.doc_id and r.kept for r in n.near_duplicates(docs).collect())
    buckets = next(f for f in kept if {"key", "doc", "n"} == set(f.columns))
    assert buckets.count() > 20
    assert [f.count() for f in kept if "set" in f.columns] == [0]


def test_large_buckets(spark):
    """Sets around several centres, in buckets of many members, against brute force."""
    rng, rows = random.Random(6), half_alike(random.Random(7), 1000)
    base = [f"w{k}" for k in range(60)]
    for i in range(40):
        words = list(base)
        for _ in range(rng.randrange(5)):
            words[rng.randrange(60)] = f"x{rng.randrange(3)}"
        rows.append((i, " ".join(words)))
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    least = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    least[a] = least[b] = min(least[a], least[b])
        if all(least[least[i]] == least[i] for i in sets):
            break
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = {r.doc_id: r.component_id for r in n.near_duplicates(docs).collect()}
    assert 1 < len({least[i] for i in range(40)}) < 40
    assert found == least
