"""Reading every partition from its own start offset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.pin import Pinned, pin
from tidelog.schema import ENVELOPE, KEY


def after_starts(
    records: DataFrame,
    starts: DataFrame | Pinned,
    *,
    new_partitions: bool = False,
    required: bool = False,
) -> DataFrame:
    """Records at or past the start of their partition, as envelopes plus extra columns.

    Works on batch and streaming records. ``starts`` holds one row per partition; it
    is pinned and joined on the partition: Spark broadcasts it below its own threshold in bytes, which leaves the log
    unshuffled, and splits hot partitions of a shuffled join otherwise. With ``new_partitions`` a
    partition without a start is read from its beginning; with ``required`` a record
    of such a partition fails the job. Otherwise it is left out.
    """
    pinned = starts if isinstance(starts, Pinned) else pin(starts)
    if not (new_partitions or required):
        low = pinned.lowest("next_offset")
        if low is not None:
            records = records.where(F.col("_offset") >= low)  # reaches the parquet scan
    how = "left" if new_partitions or required else "inner"
    columns = records.columns
    joined = records.join(pinned.frame, KEY, how)
    absent = F.lit(0)
    if required:
        name = F.concat(F.col("_topic"), F.lit("/"), F.col("_partition").cast("string"))
        absent = F.raise_error(F.concat(F.lit("partition has no start offset: "), name)).cast("bigint")
    return joined.where(F.col("_offset") >= F.coalesce("next_offset", absent)).select(
        *ENVELOPE.names, *(c for c in columns if c not in ENVELOPE.names)
    )
