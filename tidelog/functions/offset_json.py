"""Offset JSON ``{"topic": {"partition": last_offset}}`` to rows and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _entries(key: str, value: str) -> Column:
    # collect_list has no order of its own, so the entries are sorted.
    return F.sort_array(F.collect_list(F.struct(key, value)))


def encode_topics(offsets: DataFrame, value: str = "last_offset") -> DataFrame:
    """One row per topic: ``_topic``, ``offsets`` (JSON of its partitions, in order)."""
    partitions = F.map_from_entries(_entries("_partition", value))
    return offsets.groupBy("_topic").agg(F.to_json(partitions).alias("offsets"))


def encode_offsets(offsets: DataFrame, value: str = "last_offset") -> DataFrame:
    """One row, one column ``offsets``: the whole position as JSON (``{}`` when empty)."""
    topics = offsets.groupBy("_topic").agg(_entries("_partition", value).alias("entries"))
    nested = F.transform(
        _entries("_topic", "entries"),
        lambda topic: F.struct(topic["_topic"], F.map_from_entries(topic["entries"])),
    )
    return topics.agg(F.to_json(F.map_from_entries(nested)).alias("offsets"))


def decode_offsets(documents: DataFrame, column: str = "offsets") -> DataFrame:
    """Rows ``_topic, _partition, last_offset`` of offset JSON; bad input fails the job."""
    parsed = F.from_json(column, "map<string,map<string,bigint>>", {"mode": "FAILFAST"})
    topics = documents.select(F.explode(_not_null(parsed, "document")).alias("_topic", "partitions"))
    entries = topics.select(
        "_topic", F.explode(_not_null(F.col("partitions"), "topic")).alias("p", "o")
    )
    return entries.select(
        "_topic",
        _not_null(F.expr("try_cast(p AS int)"), "partition number").alias("_partition"),
        _not_null(F.col("o"), "offset").alias("last_offset"),
    )


def _not_null(value: Column, what: str) -> Column:
    problem = F.raise_error(F.lit(f"offset JSON: missing or malformed {what}"))
    return F.when(value.isNotNull(), value).otherwise(problem)
