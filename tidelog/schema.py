"""Fixed column sets shared by every reader, operator and table.

Two offset columns exist and never mix: ``last_offset`` is the last record a
consumer has read (what groups commit and offset JSON carries), ``next_offset``
is the first record a scan returns, always ``last_offset + 1``.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

#: Columns that identify one topic-partition.
KEY = ["_topic", "_partition"]

#: One record as a reader sees it.
ENVELOPE = StructType(
    [
        StructField("_key", BinaryType(), True),
        StructField("_message", BinaryType(), True),
        StructField("_topic", StringType(), False),
        StructField("_partition", IntegerType(), False),
        StructField("_offset", LongType(), False),
    ]
)

#: Data files below ``<root>/data``; the last three columns come from the path.
DATA_FILES = StructType(
    [
        StructField("_key", BinaryType()),
        StructField("_message", BinaryType()),
        StructField("_offset", LongType()),
        StructField("_append", LongType()),
        StructField("_topic", StringType()),
        StructField("_partition", IntegerType()),
    ]
)

#: One row per data file, below ``<root>/manifest``; ``_append`` is in the path.
MANIFEST = StructType(
    [
        StructField("_topic", StringType()),
        StructField("_partition", IntegerType()),
        StructField("file", StringType()),
        StructField("min_offset", LongType()),
        StructField("max_offset", LongType()),
        StructField("rows", LongType()),
        StructField("bytes", LongType()),
        # Rows and bytes of each row group; null where they could not be read.
        StructField("group_rows", ArrayType(LongType())),
        StructField("group_bytes", ArrayType(LongType())),
        # The append before this one that has records of the partition, -1 if none has.
        StructField("previous", LongType()),
        StructField("_append", LongType()),
    ]
)

#: One row per topic-partition after an append, below ``<root>/heads/_append=<n>``; ``append`` is its newest one with records.
HEADS = StructType(
    [
        StructField("_topic", StringType()),
        StructField("_partition", IntegerType()),
        StructField("earliest", LongType()),
        StructField("latest", LongType()),
        StructField("append", LongType()),
    ]
)

#: Committed positions; the first three columns are directories of the table.
GROUP_OFFSETS = StructType(
    [
        StructField("group_id", StringType()),
        StructField("query_id", StringType()),
        StructField("batch_id", LongType()),
        StructField("committed_at", TimestampType()),
        StructField("_topic", StringType()),
        StructField("_partition", IntegerType()),
        StructField("last_offset", LongType()),
    ]
)

#: Where a scan begins in every topic-partition.
STARTS = StructType(
    [
        StructField("_topic", StringType()),
        StructField("_partition", IntegerType()),
        StructField("next_offset", LongType()),
    ]
)

#: Positions of a stream after a batch, and the append that it has read up to.
BATCH_STATE = StructType([*STARTS.fields, StructField("append", LongType())])

#: Ranges of offsets without a hole, both ends included.
RUNS = StructType([*STARTS.fields[:2], StructField("first", LongType()), StructField("last", LongType())])
