"""Centroid clustering of integer vectors, nearest centroids found by a progressive search in Walsh-Hadamard order.

Vectors of exactly 64 finite components become integers ``floor(1024 * x)``. They are transformed once by the integer
Walsh-Hadamard matrix ``H`` (64 rows of +1 and -1, ordered by their number of sign changes); since ``H H' = 64 I``, squared
distances between transforms are exactly 64 times those between vectors. For a vector and all centroids, squared differences
are accumulated from coarse coefficients to fine ones in ``STEPS``. At each step the centroid with the smallest sum so far is
carried to all 64 coefficients, and every centroid whose partial sum is already strictly larger than that distance is
eliminated: its full distance can only be larger still. What is left is finished, so distances and ties (smaller number) are
those of a full search.

A round reads the stored transforms and sends sums per task and centroid (8 rows a task); sums are kept in the transform's
domain, where adding and transforming commute, and the driver turns 8 rows of 64 sums into centroids with whole numbers.
Nothing else leaves the tasks; the work of a round is one pass over the vectors whatever their number, and a vector that is
very common costs no more than others.

Nulls and ties: null vectors, other lengths, and vectors with a null or non-finite component are left out. Rows that share a
vec_id are vectors of their own. First centroids are ordered by hash, then by their coefficients; the hash of a null vec_id is that of
``3:-``. Fewer than 8 vectors give as many centroids; an empty table gives an empty result. Components that are too large for
whole numbers of 64 bits are computed with Python's integers; a squared distance or an inertia that a long cannot hold
fails the job. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import stored

SIZE = 64
SCALE = 1024
CENTROIDS = 8
ROUNDS = 10
#: Coefficients that are known after each step of the search; the last step completes them.
STEPS = (4, 8, 16, 32, SIZE)
#: Vectors compared at once; bounds a task's memory.
BLOCK = 8192
#: Components below this leave room in 64 bits: a coefficient is below 2**26, a sum of squared differences below 2**60.
SAFE = 2**20

HELD = "vec_id bigint, coefficients binary, large string"
SUMS = ", ".join(["cluster int", "n bigint", *(f"s{k} decimal(38,0)" for k in range(SIZE))])


def hadamard() -> np.ndarray:
    """The 64 x 64 matrix, rows in order of their sign changes (coarse to fine)."""
    matrix = np.ones((1, 1), np.int64)
    while len(matrix) < SIZE:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    changes = (matrix[:, 1:] != matrix[:, :-1]).sum(axis=1)
    return matrix[np.argsort(changes)]


H = hadamard()


def transformed(whole: np.ndarray) -> np.ndarray:
    """Coefficients of integer vectors (rows), exact."""
    if whole.dtype != object and (not whole.size or np.abs(whole).max() < SAFE):
        return (whole.astype(np.float64) @ H.T.astype(np.float64)).astype(np.int64)  # sums below 2**26, exact in doubles
    return whole.astype(object) @ H.T.astype(object)


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """``floor(1024 * x)`` of finite doubles, as Python's integers where one is large."""
    if not values.size or np.abs(values).max() * SCALE < SAFE:
        return np.floor(values * SCALE).astype(np.int64)
    floors = [int(np.floor(x * SCALE)) if abs(x) < 2**43 else int(x) * SCALE for x in values.ravel().tolist()]
    return np.array(floors, object).reshape(values.shape)


def _held(coefficients: np.ndarray) -> list[pa.Array]:
    """Rows as the columns ``coefficients`` (8 bytes each) and ``large`` (decimal text; where one does not fit that)."""
    if coefficients.dtype != object:
        return [pa.array([x.tobytes() for x in coefficients], pa.binary()), pa.nulls(len(coefficients), pa.string())]
    return [pa.nulls(len(coefficients), pa.binary()), pa.array([",".join(map(str, x)) for x in coefficients], pa.string())]


def _vectors(coefficients: list[bytes | None], large: list[str | None]) -> np.ndarray:
    if all(x is not None for x in coefficients):
        return np.frombuffer(b"".join(coefficients), np.int64).reshape(-1, SIZE)
    both = zip(coefficients, large)
    return np.array([np.frombuffer(x, np.int64).tolist() if x is not None else list(map(int, y.split(","))) for x, y in both], object)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid and 64 times its squared distance for each row, and how many coefficients were compared."""
    count, most = len(vectors), len(centroids)
    kind = object if object in (vectors.dtype, centroids.dtype) else np.int64
    sums = np.zeros((count, most), kind)
    left = np.ones((count, most), bool)
    compared, known = 0, 0
    at = np.arange(count)
    carried = np.full(count, -1)  # the centroid carried to all coefficients last, and the smallest such distance
    bound = np.zeros(count, kind)
    for upto in STEPS:
        row, col = np.nonzero(left)
        step = vectors[row, known:upto] - centroids[col, known:upto]
        sums[row, col] += (step * step).sum(axis=1)
        compared += step.size
        known = upto
        if upto == SIZE or not count:
            break
        best = np.where(left, sums, sums.max() + 1).argmin(axis=1)
        new = at[best != carried]
        rest = vectors[new, upto:] - centroids[best[new], upto:]
        full = sums[new, best[new]] + (rest * rest).sum(axis=1)
        compared += rest.size
        bound[new] = np.where(carried[new] < 0, full, np.minimum(bound[new], full))
        carried[new] = best[new]
        left &= sums <= bound[:, None]
    final = np.where(left, sums, sums.max() + 1 if count else 0)
    best = final.argmin(axis=1)
    return best, final[np.arange(count), best], compared


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("vector")
        right = pc.fill_null(pc.equal(pc.list_value_length(column), SIZE), False)
        batch = batch.filter(right)
        flat = pc.list_flatten(batch.column("vector"))
        values = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, SIZE)  # nulls become nan
        good = np.isfinite(values).all(axis=1)
        batch, values = batch.filter(pa.array(good)), values[good]
        for begin in range(0, len(values), BLOCK):
            whole = whole_numbers(values[begin : begin + BLOCK])
            ids = batch.column("vec_id").slice(begin, len(whole))
            yield pa.RecordBatch.from_arrays([ids, *_held(transformed(whole))], ["vec_id", "coefficients", "large"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for begin in range(0, batch.num_rows, BLOCK):
            block = batch.slice(begin, BLOCK)
            yield block, _vectors(block.column("coefficients").to_pylist(), block.column("large").to_pylist())


def _summed(centroids: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and sums of coefficients per centroid, for all vectors of a task."""
    n = np.zeros(len(centroids), np.int64)
    sums = np.zeros((len(centroids), SIZE), object)
    for _, vectors in _blocks(batches):
        best, _, _ = nearest(vectors, centroids)
        for k in np.unique(best):
            own = vectors[best == k]
            n[k] += len(own)
            sums[k] += own.sum(axis=0).astype(object)
    met = np.nonzero(n)[0]
    columns = [pa.array(met, pa.int32()), pa.array(n[met])]
    columns += [pa.array([Decimal(int(x)) for x in sums[met, k]], pa.decimal128(38, 0)) for k in range(SIZE)]
    yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", *(f"s{k}" for k in range(SIZE))])


def _assigned(centroids: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block, vectors in _blocks(batches):
        best, distance, _ = nearest(vectors, centroids)
        yield pa.RecordBatch.from_arrays(
            [block.column("vec_id"), pa.array(best, pa.int32()), pa.array([int(x) // SIZE for x in distance], pa.int64())],
            ["vec_id", "cluster", "distance"],
        )


def _first_hash() -> Column:
    return F.sha2(F.concat(F.lit("3:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("-"))), 256)


def _components(centroids: np.ndarray) -> list[list[int]]:
    """Vectors of transformed centroids: ``H' H = 64 I``."""
    return [[int(x) // SIZE for x in row] for row in centroids.astype(object) @ H.astype(object)]


def _narrow(rows: list[list[int]]) -> np.ndarray:
    large = any(abs(x) >= SAFE for row in rows for x in row)
    return transformed(np.array(rows, object if large else np.int64).reshape(-1, SIZE))


def clusters(embeddings: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector."""
    spark = embeddings.sparkSession
    rows = embeddings.select(
        F.col(id_column).cast("bigint").alias("vec_id"), F.col(column).cast("array<double>").alias("vector")
    )
    vectors = stored(rows.mapInArrow(_kept, HELD))
    start = vectors.select(_first_hash().alias("hash"), "coefficients", "large").orderBy("hash", "coefficients", "large").limit(CENTROIDS).collect()
    if not start:
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    centroids = _vectors([r["coefficients"] and bytes(r["coefficients"]) for r in start], [r["large"] for r in start])
    for _ in range(ROUNDS):
        parts = vectors.select("coefficients", "large").mapInArrow(partial(_summed, centroids), SUMS)
        sums = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *(F.sum(f"s{k}").alias(f"s{k}") for k in range(SIZE))).collect()
        components = _components(centroids)
        for row in sums:
            # Sums of coefficients back to 64 times the sums of components.
            total = np.array([int(row[f"s{k}"]) for k in range(SIZE)], object) @ H.astype(object)
            components[row["cluster"]] = [int(x) // SIZE // row["n"] for x in total]
        centroids = _narrow(components)
    assigned = stored(vectors.mapInArrow(partial(_assigned, centroids), "vec_id bigint, cluster int, distance bigint"))
    inertia = {r["cluster"]: r["d"] for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    of_cluster = spark.createDataFrame(
        [
            (k, int(inertia[k]), int(sum(inertia.values())), ",".join(map(str, row)))
            for k, row in enumerate(_components(centroids))
            if k in inertia
        ],
        "cluster int, cluster_inertia bigint, inertia bigint, components string",
    )
    named = of_cluster.withColumn("centroid_sha256", F.sha2("components", 256)).drop("components")
    return assigned.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
