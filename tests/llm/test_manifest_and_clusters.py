"""Merkle manifest and centroid clusters against brute force, with nulls, repeated rows, ties, long texts and empty tables."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tidelog.llm import centroid_clusters, merkle_manifest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, tree string, lo bigint, digest string, _copy string"
VECTORS = "vec_id bigint, embedding array<double>, cluster int, coefficients string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    fields = [row[0], row[3], row[2], row[4], row[1]]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def merkle(rows):
    """``(doc_id, leaf, subroot, root, proof, folded, verified)`` of all rows, sorted."""
    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row[2]].append(row)

    def levels_of(digests):
        levels = [digests]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
        return levels

    def path(levels, i):
        for level in levels[:-1]:
            first = i // 8 * 8
            yield "".join(level[first:i]), "".join(level[i + 1 : first + 8])
            i //= 8

    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[lang] = levels_of([leaf_of(r) for r in by_lang[lang]])
    top = levels_of([trees[lang][-1][0] for lang in langs])
    root, out = top[-1][0], []
    for at, lang in enumerate(langs):
        for i, row in enumerate(by_lang[lang]):
            walk = [*path(trees[lang], i), *path(top, at)]
            node = leaf = leaf_of(row)
            if row[0] is not None and row[1] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[1])
                node = leaf_of((row[0], lowered, *row[2:]))
            for before, after in walk:
                node = sha(before + node + after)
            out.append((row[0], leaf, trees[lang][-1][0], root, sha("".join(a + b for a, b in walk)), node, node == root))
    return sorted(out, key=repr)


def found(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def documents(count, seed=1):
    rng = random.Random(seed)
    langs = ["en"] * 6 + ["de", "é", "EN", "", None]
    rows = [(i * 7 - 20, rng.choice(["Abc", "Ünï X", "x" * 30_000, "", None, "low"]), rng.choice(langs), rng.choice(["s", None]), i) for i in range(count)]
    rows += [(None, "No Id", "en", None, None), (None, None, None, None, None), (8, "Again", "en", "s", 1), (8, "Again", "en", "s", 1)]
    return [(*row, "t", 1, "d", "c") for row in rows]


@pytest.mark.parametrize("count", [0, 9, 600])
def test_manifest(spark, count):
    rows = documents(count)
    got = found(merkle_manifest.manifest(spark.createDataFrame(rows, DOCS).repartition(5)))
    assert got == merkle([row[:5] for row in rows])
    assert not all(r[-1] for r in got) or count < 8


def test_one_document_is_its_own_root(spark):
    row = (3, "only", "en", "s", 4, None, None, None, None)
    assert found(merkle_manifest.manifest(spark.createDataFrame([row], DOCS))) == merkle([row[:5]])


def test_copies_of_one_document(spark):
    rows = [(5, "Same", "en", "s", 4, None, None, None, None)] * 300
    assert found(merkle_manifest.manifest(spark.createDataFrame(rows, DOCS).repartition(7))) == merkle([r[:5] for r in rows])


def test_many_languages(spark):
    rows = [(i, f"T{i}", f"l{i % 90}", None, i, None, None, None, None) for i in range(200)]
    assert found(merkle_manifest.manifest(spark.createDataFrame(rows, DOCS).repartition(3))) == merkle([r[:5] for r in rows])


def test_empty_manifest(spark):
    frame = merkle_manifest.manifest(spark.createDataFrame([], DOCS))
    assert frame.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert frame.collect() == []


# --- clusters ---


def lloyd(rows):
    whole = sorted(((sha(f"3:{i}"), i, [math.floor(1024 * x) for x in v]) for i, v in rows), key=lambda r: (r[0], r[2]))
    points = np.array([v for *_, v in whole], object)
    centroids = points[:8].copy()

    def nearest():
        squares = np.array([((points - c) ** 2).sum(axis=1) for c in centroids])
        return squares.argmin(axis=0), squares.min(axis=0)

    for _ in range(10):
        own, _ = nearest()
        for k in range(len(centroids)):
            if (own == k).any():
                centroids[k] = [int(s) // int((own == k).sum()) for s in points[own == k].sum(axis=0)]
    own, squares = nearest()
    digest = [sha(",".join(map(str, c))) for c in centroids]
    return sorted(
        ((i, int(k), int(d), int(squares[own == k].sum()), int(squares.sum()), digest[k]) for (_, i, _), k, d in zip(whole, own, squares)),
        key=repr,
    )


def vectors(count, scale=1.0, seed=2):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(5)]
    return [(i, [scale * (c + rng.gauss(0, 0.6)) for c in centres[i % 5]]) for i in range(count)]


def frame_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], VECTORS).repartition(3)


@pytest.mark.parametrize("count, scale", [(300, 0.3), (5, 1.0), (60, 3000.0)])
def test_clusters(spark, count, scale):
    rows = vectors(count, scale)
    assert found(centroid_clusters.clusters(frame_of(spark, rows))) == lloyd(rows)


def test_odd_vectors_are_left_out(spark):
    rows = vectors(40)
    odd = [(100, None), (101, [1.0] * 63), (102, [1.0] * 63 + [None]), (103, [float("nan")] * 64), (104, [float("inf")] * 64), (105, [])]
    assert found(centroid_clusters.clusters(frame_of(spark, rows + odd))) == lloyd(rows)


def test_ties_and_copies(spark):
    rows = [(i, [0.5 if i % 2 else -0.5] * 64) for i in range(40)] + [(100 + i, [0.0] * 64) for i in range(20)]
    assert found(centroid_clusters.clusters(frame_of(spark, rows))) == lloyd(rows)


def test_rows_without_id_and_with_the_same_id(spark):
    rows = [*vectors(12), *vectors(12, seed=5)]
    frame = spark.createDataFrame([*((i, v, 1, "x") for i, v in rows), (None, [0.25] * 64, 1, "x")], VECTORS)
    got = found(centroid_clusters.clusters(frame))
    assert len(got) == 25 and [r[0] for r in got].count(None) == 1
    assert got == found(centroid_clusters.clusters(frame.repartition(5)))


def test_no_vectors(spark):
    frame = centroid_clusters.clusters(spark.createDataFrame([], VECTORS))
    assert frame.collect() == [] and frame.columns[0] == "vec_id"


def test_search_agrees_with_full_distances_and_compares_less():
    rng = np.random.default_rng(4)
    centres = rng.integers(-900, 900, (8, 64))
    points = centres[rng.integers(0, 8, 3000)] + rng.integers(-60, 60, (3000, 64))
    points[:100] = (centres[0] + centres[1]) // 2  # near ties
    best, scaled, compared = centroid_clusters.nearest(centroid_clusters.transformed(points), centroid_clusters.transformed(centres))
    squares = ((points[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (best == squares.argmin(axis=1)).all() and (scaled == 64 * squares.min(axis=1)).all()
    assert compared < 8 * 64 * len(points) / 2


def test_matrix_is_orthogonal_and_ordered():
    matrix = centroid_clusters.hadamard()
    assert (matrix @ matrix.T == 64 * np.eye(64)).all()
    assert [(row[1:] != row[:-1]).sum() for row in matrix] == list(range(64))
