"""Which partitions exist, and where each begins and ends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.envelope import subscribe
from tidelog.schema import KEY


def discover(records: DataFrame) -> DataFrame:
    """``_topic, _partition, earliest, latest`` from records; ``latest`` is one past the end."""
    return records.groupBy(*KEY).agg(
        F.min("_offset").alias("earliest"), (F.max("_offset") + 1).alias("latest")
    )


def discover_from_manifest(manifest: DataFrame) -> DataFrame:
    """The same from one row per data file, without opening any of them."""
    return manifest.groupBy(*KEY).agg(
        F.min("min_offset").alias("earliest"), (F.max("max_offset") + 1).alias("latest")
    )


def discover_topics(manifest: DataFrame, topics: Sequence[str]) -> DataFrame:
    """Partitions of the subscribed topics; a topic without any is an error."""
    partitions = discover_from_manifest(subscribe(manifest, topics))
    found = {row._topic for row in partitions.select("_topic").distinct().limit(len(topics)).collect()}
    unknown = [topic for topic in topics if topic not in found]
    if unknown:
        raise ValueError(f"no partition found for topic(s): {', '.join(unknown)}")
    return partitions
