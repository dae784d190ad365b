"""Offsets as runs: rows ``_topic, _partition, first, last``, one for each range without a hole."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.schema import KEY

#: Offsets that one bitmap stands for, as a power of two.
WORD_BITS = 6
#: Offsets whose runs are put together in one window, as a power of two; a hot partition spreads over many.
CHUNK_BITS = 16
#: Where the run of everything that has been consumed begins.
BEGINNING = -(2**63)


def _joined(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Runs that touch or overlap within ``keys``, as one each."""
    before = Window.partitionBy(*keys).orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*keys).orderBy("first", "last").rowsBetween(Window.unboundedPreceding, 0)
    marked = runs.withColumn("_apart", (F.coalesce(F.col("first") > F.max("last").over(before) + 1, F.lit(True))).cast("int"))
    numbered = marked.withColumn("_run", F.sum("_apart").over(upto))
    return numbered.groupBy(*keys, "_run").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_run")


def merge_runs(runs: DataFrame) -> DataFrame:
    """Maximal runs of all ``runs``. A partition has one for every ``2**CHUNK_BITS`` offsets and every hole at most."""
    return _joined(runs.select(*KEY, "first", "last"), KEY)


def offset_runs(records: DataFrame) -> DataFrame:
    """Maximal runs of the offsets in ``records``; repeated offsets count once.

    Offsets are combined into bitmaps map-side, 64 to a row, so neither records nor single offsets are shuffled
    where a task reads neighbours, and no window holds more than a chunk.
    """
    bit = F.expr(f"shiftleft(1L, CAST(_offset % {2**WORD_BITS} AS INT))")
    words = records.groupBy(*KEY, F.shiftright("_offset", WORD_BITS).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    begin = F.shiftleft("_word", WORD_BITS)
    whole = F.array(F.struct(begin.alias("first"), (begin + 2**WORD_BITS - 1).alias("last")))
    set_bits = F.filter(F.sequence(F.lit(0), F.lit(2**WORD_BITS - 1)), lambda k: F.getbit("_bits", k) == 1)
    single = F.transform(set_bits, lambda k: F.struct((begin + k).alias("first"), (begin + k).alias("last")))
    pieces = words.select(*KEY, F.explode(F.when(F.col("_bits") == -1, whole).otherwise(single)).alias("run"))
    chunked = pieces.select(*KEY, "run.first", "run.last", F.shiftright("run.first", CHUNK_BITS).alias("_chunk"))
    return merge_runs(_joined(chunked, [*KEY, "_chunk"]))


def consumed_before(starts: DataFrame) -> DataFrame:
    """Starts as runs: everything before a partition's start counts as read."""
    return starts.select(*KEY, F.lit(BEGINNING).alias("first"), (F.col("next_offset") - 1).alias("last"))


def reached(runs: DataFrame) -> DataFrame:
    """``last_offset`` up to which each partition of merged ``runs`` has been read without a hole."""
    return runs.where(F.col("first") == BEGINNING).select(*KEY, F.col("last").alias("last_offset"))


def holes(runs: DataFrame) -> DataFrame:
    """Ranges between merged runs: ``_topic, _partition, first, last``."""
    order = Window.partitionBy(*KEY).orderBy("first")
    followed = runs.withColumn("_next", F.lead("first").over(order))
    return followed.where("_next IS NOT NULL").select(*KEY, (F.col("last") + 1).alias("first"), (F.col("_next") - 1).alias("last"))
