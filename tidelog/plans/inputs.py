"""The log that the registered queries read, derived from the ``events`` table.

It is written once per session and input directory, below the shared folder that
``spark.checkpoint.dir`` names.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.envelope import subscribe
from tidelog.operators.pin import pin
from tidelog.options import parse_topics
from tidelog.schema import KEY
from tidelog.scratch import scratch
from tidelog.sources.group_table import GroupTable
from tidelog.sources.log_table import TopicLog

#: Subscription of the group queries; the repeated name is deliberate.
TOPICS = parse_topics("click,view,click")
#: The partition that ``g_partial`` has no position for.
UNCOMMITTED = ("view", 3)
#: The partition that returns no record in the idle-partition query.
IDLE = ("click", 2)
#: Groups with positions; ``g_none`` has none.
GROUPS = ("g_full", "g_partial", "g_rewind")
FIRST_COMMIT = datetime(2024, 2, 1, 0, 0, 0)
SECOND_COMMIT = datetime(2024, 2, 1, 0, 1, 30)


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as unnumbered records: five topics, four partitions each."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(
        F.when(F.col("event_id") % 7 != 0, F.col("user_id").cast("string").cast("binary")).alias("_key"),
        F.when(F.col("event_id") % 10 != 0, F.col("props").cast("binary")).alias("_message"),
        F.col("event_type").alias("_topic"),
        (F.col("user_id") % 4).cast("int").alias("_partition"),
        "event_id",
    )


def halfway(partitions: DataFrame) -> DataFrame:
    """Positions in the middle of every partition."""
    return partitions.select(*KEY, F.expr("(latest - 1) div 2").alias("last_offset"))


def _is(partition: tuple[str, int]):
    return (F.col("_topic") == partition[0]) & (F.col("_partition") == partition[1])


def event_cuts(records: DataFrame, parts: int = 3) -> list[tuple[int, int]]:
    """Ranges ``[low, high)`` of ``event_id`` of equal width."""
    span = records.agg(F.min("event_id").alias("low"), F.max("event_id").alias("high")).first()
    cuts = [span.low + (span.high + 1 - span.low) * i // parts for i in range(parts + 1)]
    return list(zip(cuts, cuts[1:]))


def event_slice(records: DataFrame, cut: tuple[int, int]) -> DataFrame:
    return records.where((F.col("event_id") >= cut[0]) & (F.col("event_id") < cut[1]))


def grown_log(spark: SparkSession, sf_dir: str) -> TopicLog:
    """``events`` in three appends, in order of ``event_id``; written once per session like ``event_log``."""
    return _once(spark, sf_dir, "grown", _write_grown_log)


def _write_grown_log(spark: SparkSession, sf_dir: str) -> str:
    log, records = TopicLog(spark, scratch(spark)), event_records(spark, sf_dir)
    for cut in event_cuts(records):
        log.append(event_slice(records, cut), "event_id")
    return log.root


def event_log(spark: SparkSession, sf_dir: str) -> TopicLog:
    """The numbered log of ``events`` with the positions of four groups."""
    return _once(spark, sf_dir, "events", _write_log)


def _once(spark: SparkSession, sf_dir: str, kind: str, write: Callable[[SparkSession, str], str]) -> TopicLog:
    name = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), kind)
    with _writing:
        if name not in _written or TopicLog(spark, _written[name]).last_append() < 0:
            _written[name] = write(spark, sf_dir)
        return TopicLog(spark, _written[name])


_written: dict[tuple[str, str, str], str] = {}
_writing = threading.Lock()


def _write_log(spark: SparkSession, sf_dir: str) -> str:
    log = TopicLog(spark, scratch(spark))
    log.append(event_records(spark, sf_dir), "event_id")
    partitions = pin(log.partitions()).frame
    ends = partitions.select(*KEY, (F.col("latest") - 1).alias("last_offset"))
    groups = GroupTable(spark, log.groups_path)
    groups.commit("g_full", "q1", 0, halfway(partitions), FIRST_COMMIT)
    groups.commit("g_partial", "q1", 0, halfway(partitions).where(~_is(UNCOMMITTED)), FIRST_COMMIT)
    groups.commit("g_rewind", "q1", 7, ends, FIRST_COMMIT)
    groups.commit("g_rewind", "q2", 0, halfway(partitions), SECOND_COMMIT)
    return log.root


def groups_of(log: TopicLog) -> GroupTable:
    return GroupTable(log.spark, log.groups_path)


def subscribed(log: TopicLog) -> DataFrame:
    return subscribe(log.partitions(), TOPICS)


def full_group_starts(log: TopicLog) -> DataFrame:
    return groups_of(log).latest("g_full").select(*KEY, (F.col("last_offset") + 1).alias("next_offset"))


def batch_with_idle_partition(log: TopicLog, starts: DataFrame) -> DataFrame:
    """Everything past ``starts`` but the records of one partition."""
    return log.rows_after(starts).where(~_is(IDLE))
