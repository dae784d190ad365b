"""Positions reached by a read, as ``_topic, _partition, last_offset``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.schema import KEY


def progress(records: DataFrame) -> DataFrame:
    """Last offset read in each partition that returned records."""
    return records.groupBy(*KEY).agg(F.max("_offset").alias("last_offset"))


def merge_offsets(starts: DataFrame, reached: DataFrame) -> DataFrame:
    """One position per started partition; an idle one keeps where it began."""
    began = F.col("next_offset") - 1
    return starts.join(reached, KEY, "left").select(
        *KEY, F.greatest(began, F.coalesce("last_offset", began)).alias("last_offset")
    )


def compare_offsets(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: ``partitions`` compared, ``different`` ones, and whether all are ``equal``."""
    other = right.select(*KEY, F.col("last_offset").alias("other"))
    different = F.count_if(~F.col("last_offset").eqNullSafe(F.col("other")))
    return left.join(other, KEY, "full").agg(
        F.count("*").alias("partitions"),
        different.alias("different"),
        (different == 0).alias("equal"),
    )


def offsets_equal(left: DataFrame, right: DataFrame) -> bool:
    return bool(compare_offsets(left, right).first()["equal"])
