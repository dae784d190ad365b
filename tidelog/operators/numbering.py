"""Gap-free offsets for rows that have none yet.

A plain ``row_number`` over a topic-partition would sort all of it in one task.
Here each topic-partition is cut into chunks of about ``2**bits`` rows, at quantiles of the order
column from a mergeable sketch, so it does not matter how ids are spread. A window sees one chunk; the offsets
before each chunk come from counts that are pre-aggregated map-side. There are as many chunks as
files, not as records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.operators.pin import pin
from tidelog.schema import KEY

CHUNK_BITS = 20
#: Most chunks of one topic-partition; the sketch tells ranks apart to about this part of the rows.
CHUNKS = 1024
#: Size of a sketch: its ranks are off by about a thousandth.
SKETCH = 4096
#: Sketches of a topic-partition are merged in so many groups first.
SALTS = 64
#: Most chunk bounds (longs) that are broadcast to the rows; beyond that they are joined by shuffle.
BROADCAST_BOUNDS = 4_000_000
_STEP = 32


def _fail(message: str, value: str) -> Column:
    text = F.concat(F.lit(f"{message}: "), F.coalesce(F.col(value).cast("string"), F.lit("null")))
    return F.raise_error(text).cast("bigint")


def _present(name: str) -> Column:
    failed = F.raise_error(F.lit(f"column '{name}' is null in records to append"))
    return F.when(F.col(name).isNull(), failed).otherwise(F.col(name))


def chunk_bounds(rows: DataFrame, order: str, bits: int) -> DataFrame:
    """``_topic, _partition, bounds``: ascending values of ``order`` that begin every chunk but the first."""
    salt = F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("_salt")
    parts = rows.groupBy(*KEY, salt).agg(F.count("*").alias("n"), F.kll_sketch_agg_bigint(order, F.lit(SKETCH)).alias("sketch"))
    whole = parts.groupBy(*KEY).agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch", F.lit(SKETCH)).alias("sketch"))
    chunks = F.least(F.lit(CHUNKS), F.ceil(F.col("n") / 2**bits)).cast("int")
    cut = whole.withColumn("chunks", chunks).where("chunks > 1")
    quantiles = F.kll_sketch_get_quantile_bigint("sketch", F.array(*(F.lit(k / CHUNKS) for k in range(1, CHUNKS))))
    spread = cut.withColumn("quantiles", quantiles)
    bounds = F.transform(F.sequence(F.lit(1), F.col("chunks") - 1), lambda k: F.get("quantiles", F.floor(k * CHUNKS / F.col("chunks")).cast("int") - 1))
    return spread.select(*KEY, F.array_sort(F.array_distinct(bounds)).alias("bounds"))


def _at_or_below(bounds: Column, value: Column) -> Column:
    return F.size(F.filter(bounds, lambda bound: bound <= value))


def _chunk(bounds: Column, value: Column) -> Column:
    """How many bounds are at or below a value, found in two steps."""
    steps = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.floor(F.size(bounds) / _STEP).cast("int"))), lambda k: F.get(bounds, k * _STEP - 1))
    passed = F.when(F.size(bounds) < _STEP, 0).otherwise(_at_or_below(steps, value))
    return F.coalesce(_STEP * passed + _at_or_below(F.slice(bounds, _STEP * passed + 1, F.lit(_STEP)), value), F.lit(0))


def _with_chunks(rows: DataFrame, order: str, bits: int) -> DataFrame:
    pinned = pin(chunk_bounds(rows, order, bits))
    bounds = pinned.frame
    total = bounds.agg(F.sum(F.size("bounds"))).first()[0]
    if not total:
        return rows.withColumn("_chunk", F.lit(0))
    if total <= BROADCAST_BOUNDS:
        bounds = F.broadcast(bounds)
    return rows.join(bounds, KEY, "left").withColumn("_chunk", _chunk(F.col("bounds"), F.col(order))).drop("bounds")


def _chunk_starts(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """First offset of every (topic, partition, chunk)."""
    chunks = rows.groupBy(*KEY, "_chunk").agg(F.count("*").alias("n"))
    window = Window.partitionBy(*KEY).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    begun = chunks.join(heads.select(*KEY, "next_offset"), KEY, "left")
    return begun.select(
        *KEY, "_chunk", (F.coalesce("next_offset", F.lit(0)) + F.coalesce(F.sum("n").over(window), F.lit(0))).alias("_start")
    )


def number_offsets(
    rows: DataFrame, order: str, heads: DataFrame, tasks: int, bits: int = CHUNK_BITS
) -> DataFrame:
    """Add ``_offset``: position of each row by ``order`` in its topic-partition.

    ``order`` is a unique bigint column without nulls; a null key or order, or an
    order that repeats within a partition, fails the job. ``heads`` holds the
    ``next_offset`` of partitions that already have records. The output has
    ``tasks`` range partitions, each sorted, with disjoint offset ranges. The one
    wide shuffle carries each chunk's start as an extra leading row, which saves
    joining the rows with a table of chunks.
    """
    rows = rows.withColumns({name: _present(name) for name in (*KEY, order)})
    marked = _with_chunks(rows, order, bits)
    starts = _chunk_starts(marked, heads)
    together = marked.withColumn("_start", F.lit(None).cast("bigint")).unionByName(starts, allowMissingColumns=True)
    spread = together.repartitionByRange(tasks, *KEY, "_chunk")
    in_chunk = Window.partitionBy(*KEY, "_chunk").orderBy(F.col(order).asc_nulls_first())
    start = F.first("_start").over(in_chunk.rowsBetween(Window.unboundedPreceding, 0))
    repeats = F.lag(order).over(in_chunk) == F.col(order)
    offset = start + F.row_number().over(in_chunk) - 2
    numbered = spread.withColumn(
        "_offset", F.when(repeats, _fail(f"column '{order}' repeats", order)).otherwise(offset)
    )
    return numbered.where(F.col("_start").isNull()).drop("_chunk", "_start")
