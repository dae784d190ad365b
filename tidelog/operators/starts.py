"""Where a read begins: committed positions of a group, else the reset policy.

A restored checkpoint outranks both; Structured Streaming applies it by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.options import LARGEST, SMALLEST
from tidelog.schema import KEY


def resolve_starts(partitions: DataFrame, committed: DataFrame, reset: str) -> DataFrame:
    """``_topic, _partition, next_offset`` for every discovered partition.

    The group's positions count only if they cover all partitions; one gap sends
    every partition to the reset policy. A reset reads from the first record
    (``smallest``) or the first future one (``largest``), without skipping any.
    """
    if reset not in (SMALLEST, LARGEST):
        raise ValueError(f"reset policy must be {SMALLEST} or {LARGEST}")
    matched = partitions.join(committed.select(*KEY, "last_offset"), KEY, "left")
    covered = matched.agg(F.count("*") == F.count("last_offset")).scalar()
    fallback = F.col("earliest" if reset == SMALLEST else "latest")
    return matched.select(
        *KEY, F.when(covered, F.col("last_offset") + 1).otherwise(fallback).alias("next_offset")
    )


def starts_after(offsets: DataFrame) -> DataFrame:
    """Starts that continue from consumed positions, as restored from offset JSON."""
    return offsets.select(*KEY, (F.col("last_offset") + 1).alias("next_offset"))


def add_new_partitions(partitions: DataFrame, starts: DataFrame) -> DataFrame:
    """Starts extended by partitions they lack, each from its first record."""
    return partitions.join(starts, KEY, "full").select(
        *KEY, F.coalesce("next_offset", "earliest").alias("next_offset")
    )


def start_problems(partitions: DataFrame, starts: DataFrame) -> DataFrame:
    """Partitions that cannot be read from their start: ``_topic, _partition, problem``."""
    problem = (
        F.when(F.col("next_offset").isNull(), "partition has no start offset")
        .when(F.col("latest").isNull(), "start offset names a partition that does not exist")
        .when(F.col("next_offset") < F.col("earliest"), "records before the earliest are gone")
        .when(F.col("next_offset") > F.col("latest"), "start offset lies beyond the end of the log")
    )
    return (
        partitions.join(starts, KEY, "full")
        .select(*KEY, problem.alias("problem"))
        .where("problem IS NOT NULL")
    )


def require_starts(partitions: DataFrame, starts: DataFrame) -> None:
    """Fail, naming some of the offenders, unless every partition can be read."""
    problems = start_problems(partitions, starts)
    found = problems.orderBy(*KEY).limit(5).collect()
    if found:
        named = "; ".join(f"{r._topic}/{r._partition}: {r.problem}" for r in found)
        raise ValueError(f"{named} ({problems.count()} in all)")


def offset_gaps(manifest: DataFrame, starts: DataFrame) -> DataFrame:
    """Offset ranges past the starts that no file holds: ``_topic, _partition, first, last``.

    One row of the manifest stands for a file, so a window over a partition's files is short.
    A file with fewer rows than its range has lost some inside; the whole range is named.
    """
    due = manifest.join(starts.select(*KEY, "next_offset"), KEY).where("max_offset >= next_offset")
    files = Window.partitionBy(*KEY).orderBy("min_offset")
    upto = F.coalesce(F.lag("max_offset").over(files) + 1, F.least("next_offset", "min_offset"))
    followed = due.withColumn("upto", F.greatest(upto, F.least("next_offset", "min_offset")))
    between = F.when(F.col("min_offset") > F.col("upto"), F.struct(F.col("upto").alias("first"), (F.col("min_offset") - 1).alias("last")))
    inside = F.when(
        F.col("rows") != F.col("max_offset") - F.col("min_offset") + 1,
        F.struct(F.col("min_offset").alias("first"), F.col("max_offset").alias("last")),
    )
    gaps = followed.select(*KEY, F.explode(F.array_compact(F.array(between, inside))).alias("gap"))
    return gaps.select(*KEY, "gap.first", "gap.last")


def require_no_gaps(manifest: DataFrame, starts: DataFrame) -> None:
    """Fail, naming some of the ranges, if records past the starts are missing from the log."""
    gaps = offset_gaps(manifest, starts)
    found = gaps.orderBy(*KEY, "first").limit(5).collect()
    if found:
        named = "; ".join(f"{r._topic}/{r._partition}: offsets {r['first']} to {r['last']} are missing" for r in found)
        raise ValueError(f"{named} ({gaps.count()} in all)")
