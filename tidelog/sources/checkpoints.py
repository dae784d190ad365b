"""Where a streaming query's checkpoint stands, as starts for a batch read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.offset_json import decode_offsets
from tidelog.schema import KEY
from tidelog.sources.files import exists

#: Lines of an entry of the offset log before those of its sources: version and metadata.
HEADER_LINES = 2


def _entries(spark: SparkSession, path: str) -> DataFrame:
    """``batch_id, value`` of the log files below a folder; one file is one batch."""
    files = spark.read.text(path, wholetext=True)
    named = files.select(F.expr("try_cast(_metadata.file_name AS bigint)").alias("batch_id"), "value")
    return named.where("batch_id IS NOT NULL")


def checkpoint_starts(spark: SparkSession, path: str, source: int = 0) -> DataFrame:
    """``_topic, _partition, next_offset`` after the last batch that the query at checkpoint ``path`` has committed.

    A batch that is planned but not committed does not count: its records may not have reached the sink. ``source`` is the
    number of the stream among those of the query; it must be one that keeps offsets by topic and partition.
    """
    path = path.rstrip("/")
    if not exists(spark, f"{path}/commits"):
        raise ValueError("the checkpoint has no committed batch")
    planned = _entries(spark, f"{path}/offsets")
    committed = _entries(spark, f"{path}/commits").select("batch_id")
    newest = planned.join(committed, "batch_id").agg(F.max_by("value", "batch_id").alias("value"))
    line = F.get(F.split("value", "\n"), F.lit(HEADER_LINES + source))
    document = newest.select(line.alias("offsets"))
    if document.where("offsets IS NOT NULL").isEmpty():
        raise ValueError(f"the checkpoint has no committed batch, or no source {source}")
    return decode_offsets(document).select(*KEY, F.col("last_offset").alias("next_offset"))
