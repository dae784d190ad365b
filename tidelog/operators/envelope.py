"""Projections and filters over record envelopes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.schema import ENVELOPE


def to_envelope(records: DataFrame) -> DataFrame:
    """Envelope columns in their fixed order and types."""
    return records.select(*(F.col(f.name).cast(f.dataType) for f in ENVELOPE.fields))


def subscribe(records: DataFrame, topics: Sequence[str]) -> DataFrame:
    """Only the named topics; prunes directories on a log."""
    return records.where(F.col("_topic").isin(*topics))


def offset_range(
    records: DataFrame, topic: str, partition: int, start: int, end: int | None = None
) -> DataFrame:
    """Records of one topic-partition in ``[start, end)``."""
    kept = (
        (F.col("_topic") == topic) & (F.col("_partition") == partition) & (F.col("_offset") >= start)
    )
    return records.where(kept if end is None else kept & (F.col("_offset") < end))
