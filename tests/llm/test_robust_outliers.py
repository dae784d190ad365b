"""The estimates of op4 against concentration in numpy, from the same starts and from random ones."""

import numpy as np
import pytest

from tidelog.llm import quality_rules as q

SCHEMA = "name string, " + ", ".join(f"{d} bigint" for d in q.DIMENSIONS)
RIDGE = np.diag(np.array(q.RIDGE) * q.SCALE**2)


def moments(x):
    x = x.astype(float)
    centre = x.mean(axis=0)
    return centre, x.T @ x / len(x) - np.outer(centre, centre) + RIDGE


def distances(x, centre, cov):
    apart = x - centre
    return np.einsum("ij,ij->i", apart @ np.linalg.inv(cov), apart)


def concentrated(x, centre, cov):
    """The smallest determinant on the way from a start, with its estimate."""
    best = (np.inf, centre, cov)
    for _ in range(q.MOST_STEPS):
        classes = np.floor(q.CLASSES * np.log2(1e-6 + distances(x, centre, cov)))
        last = np.sort(classes)[int(np.ceil(q.SUBSET * len(x))) - 1]
        moved = moments(x[classes <= last])
        best = min(best, (np.linalg.slogdet(moved[1])[1], *moved), key=lambda e: e[0])
        if np.array_equal(moved[0], centre) and np.array_equal(moved[1], cov):
            break
        centre, cov = moved
    return best


def reference(x):
    low, middle, high = np.quantile(x, [0.25, 0.5, 0.75], axis=0, method="inverted_cdf")
    spread = np.sqrt(((high - low) / 1.349) ** 2 + np.diag(RIDGE))
    fenced = x[(abs(x - middle) <= q.FENCE * spread).all(axis=1)]
    starts = [(middle, np.diag(spread**2)), moments(fenced), moments(x)]
    return min((concentrated(x, *start) for start in starts), key=lambda e: e[0])


def grouped(seed, count, bad):
    """Correlated vectors, a share of which lies elsewhere, close together."""
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(4, 4)) * 300
    clean = rng.normal(size=(count, 4)) @ mix + [7000, 500, 400, 300]
    clean[: int(count * bad)] = rng.normal(size=(int(count * bad), 4)) * 40 + [9000, 6000, 5000, 200]
    return np.round(clean).astype(np.int64)


@pytest.fixture(scope="module")
def groups():
    return {"a": grouped(1, 400, 0.2), "b": grouped(2, 300, 0.0), "c": grouped(3, 500, 0.24), "same": np.full((60, 4), 5)}


@pytest.fixture(scope="module")
def fitted(spark, groups):
    rows = [(name, *map(int, x)) for name, xs in groups.items() for x in xs]
    return {r["name"]: r for r in q.estimates(spark.createDataFrame(rows, SCHEMA), ["name"]).collect()}


def estimate(row):
    cov = np.zeros((4, 4))
    for i, j in q.PAIRS:
        cov[i, j] = cov[j, i] = row[f"c{i}{j}"]
    return np.array([row[f"m{i}"] for i in range(4)]), cov


def test_every_group_as_in_numpy(groups, fitted):
    assert set(fitted) == set(groups)
    for name, x in groups.items():
        _, centre, cov = reference(x)
        found = estimate(fitted[name])
        assert np.allclose(found[0], centre, rtol=1e-9) and np.allclose(found[1], cov, rtol=1e-7, atol=1e-4), name


def test_no_random_start_is_much_smaller(groups, fitted):
    for name in "abc":
        x, rng = groups[name], np.random.default_rng(9)
        some = [concentrated(x, *moments(x[rng.choice(len(x), 8, replace=False)]))[0] for _ in range(30)]
        assert np.linalg.slogdet(estimate(fitted[name])[1])[1] <= min(some) + 0.2, name


def test_the_bad_share_lies_far(groups, fitted):
    for name, bad in (("a", 80), ("c", 120)):
        far = distances(groups[name], *estimate(fitted[name]))
        assert far[:bad].min() > far[bad:].max()


def test_repeated_vectors_count_each_time(spark, groups, fitted):
    rows = [("a", *map(int, x)) for x in groups["a"]] * 2
    twice = q.estimates(spark.createDataFrame(rows, SCHEMA), ["name"]).first()
    assert twice["n"] == 2 * fitted["a"]["n"]
    assert np.allclose(estimate(twice)[1], estimate(fitted["a"])[1])


def test_no_rows_no_groups(spark):
    assert q.estimates(spark.createDataFrame([], SCHEMA), ["name"]).count() == 0


def test_steps_end_where_an_estimate_comes_back(spark, monkeypatch):
    x = grouped(117, 120, 0.2)  # from the moments of all, the steps go to and fro between two subsets
    steps = []
    nearest = q._nearest
    monkeypatch.setattr(q, "_nearest", lambda *a: steps.append(1) or nearest(*a))
    found = q.estimates(spark.createDataFrame([("a", *map(int, v)) for v in x], SCHEMA), ["name"]).first()
    assert len(steps) < 15 < q.MOST_STEPS
    _, centre, cov = reference(x)
    assert np.allclose(estimate(found)[0], centre, rtol=1e-9) and np.allclose(estimate(found)[1], cov, rtol=1e-7, atol=1e-4)
