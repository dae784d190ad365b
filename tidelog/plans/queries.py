"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import decode_offsets, encode_offsets, encode_topics, is_tombstone, json_field, text
from tidelog.operators import (
    compare_offsets,
    discover,
    discover_topics,
    merge_offsets,
    offset_range,
    pin,
    progress,
    resolve_starts,
    start_problems,
    starts_after,
    subscribe,
    to_envelope,
)
from tidelog.plans.inputs import (
    GROUPS,
    TOPICS,
    batch_with_idle_partition,
    event_cuts,
    event_log,
    event_records,
    event_slice,
    groups_of,
    grown_log,
    halfway,
    subscribed,
)
from tidelog.schema import KEY, STARTS
from tidelog.scratch import scratch
from tidelog.operators.starts import offset_gaps as gaps_after
from tidelog.sources import GroupTable, TopicLog, checkpoint_starts, from_broker, register
from tidelog.sources.planning import LogIndex
from tidelog.streaming import freeze_starts, start_committing, start_grouped

Query = Callable[[SparkSession, str], DataFrame]

ROWS_PER_TASK = 100


def readable(records: DataFrame) -> DataFrame:
    """Envelopes with key and payload as text."""
    return records.select(text("_key").alias("_key"), text("_message").alias("_message"), *KEY, "_offset")


# --- projections and filters ---


def source_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readable(event_log(spark, sf_dir).rows())


def renamed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).rows().select(
        F.col("_topic").alias("topic"),
        F.col("_partition").alias("partition"),
        F.col("_offset").alias("position"),
        text("_key").alias("user_id"),
    )


def topic_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readable(subscribe(event_log(spark, sf_dir).rows(), TOPICS))


def offset_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readable(offset_range(event_log(spark, sf_dir).rows(), "click", 1, 100))


def tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_log(spark, sf_dir).rows().where(is_tombstone())
    return rows.select(text("_key").alias("_key"), *KEY, "_offset")


def keyless_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readable(event_log(spark, sf_dir).rows().where(F.col("_key").isNull()))


def decode_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_log(spark, sf_dir).rows().where(~is_tombstone())
    return rows.select(*KEY, "_offset", json_field("$.k", "bigint").alias("k"))


# --- discovery, starts and scans ---


def partition_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).partitions()


def partition_discovery_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover(event_log(spark, sf_dir).rows())


def _starts(log: TopicLog, group: str, reset: str) -> DataFrame:
    partitions = discover_topics(log.manifest(), TOPICS)
    return resolve_starts(partitions, groups_of(log).latest(group), reset)


def _start_query(group: str, reset: str) -> Query:
    return lambda spark, sf_dir: _starts(event_log(spark, sf_dir), group, reset)


def _scan_query(group: str, reset: str) -> Query:
    def scan(spark: SparkSession, sf_dir: str) -> DataFrame:
        log = event_log(spark, sf_dir)
        return readable(log.rows_after(_starts(log, group, reset)))

    return scan


def scan_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continue from offset JSON, as a restored checkpoint holds it."""
    log = event_log(spark, sf_dir)
    stored = encode_offsets(halfway(subscribed(log)))
    return readable(log.resume(TOPICS, starts_after(decode_offsets(stored))))


def scan_task_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each task of the named source reads, from the middle of every partition of a log of several appends."""
    log = grown_log(spark, sf_dir)
    starts: dict[str, dict[str, int]] = {}
    for row in starts_after(halfway(log.partitions())).collect():
        starts.setdefault(row._topic, {})[str(row._partition)] = row.next_offset
    index = LogIndex(log.root, starts)
    index.refresh()
    tasks = index.tasks(starts, index.latest, ROWS_PER_TASK, 2**62)
    rows = [(no, r.topic, r.partition, r.start, r.end) for no, task in enumerate(tasks) for r in task.ranges]
    return spark.createDataFrame(rows, "task bigint, _topic string, _partition int, start_offset bigint, end_offset bigint")


def missing_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts of a group that lacks a partition, with one for a partition that is not there, one too early and one too late."""
    log = event_log(spark, sf_dir)
    partitions = log.partitions()
    starts = starts_after(groups_of(log).latest("g_partial"))
    early = (F.col("_topic") == "click") & (F.col("_partition") == 0)
    late = (F.col("_topic") == "click") & (F.col("_partition") == 1)
    shifted = F.when(early, F.col("earliest") - 1).when(late, F.col("latest") + 1).otherwise(F.col("next_offset"))
    absent = spark.createDataFrame([("click", 99, 0)], STARTS)
    wrong = partitions.join(starts, KEY).select(*KEY, shifted.alias("next_offset")).unionByName(absent)
    return start_problems(partitions, wrong)


def offset_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges that a log lacks whose second of three appends is lost."""
    log = grown_log(spark, sf_dir)
    starts = log.partitions().select(*KEY, F.col("earliest").alias("next_offset"))
    return gaps_after(log.manifest().where("_append <> 1"), starts)


def source_batch_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The named source as a batch; predicates on topic, partition and offset reach its planning."""
    log = event_log(spark, sf_dir)
    register(spark)
    reader = spark.read.format("topiclog").option("topics", ",".join(_topics(log))).option("group.id", "g_batch")
    rows = reader.load(log.root)
    return readable(
        rows.where(F.col("_topic").isin(*TOPICS) & F.col("_partition").isin(1, 2) & (F.col("_offset") >= 100) & (F.col("_offset") < 300))
    )


def append_continues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three appends whose records are ordered by a hash of their id."""
    records = event_records(spark, sf_dir)
    log = TopicLog(spark, f"{scratch(spark)}/log")
    for cut in event_cuts(records):
        hashed = event_slice(records, cut).withColumn("place", F.expr("event_id * 1000003 % 2147483647 * 4294967296"))
        log.append(hashed.drop("event_id"), "place")
    return readable(log.rows())


# --- positions ---


def read_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress(event_log(spark, sf_dir).rows())


def merge_offsets_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(spark, sf_dir)
    starts = pin(_starts(log, "g_full", "smallest")).frame
    return merge_offsets(starts, progress(batch_with_idle_partition(log, starts)))


def offsets_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_topics(progress(event_log(spark, sf_dir).rows()))


def offsets_json_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_offsets(progress(event_log(spark, sf_dir).rows()))


def offsets_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_offsets(encode_offsets(progress(event_log(spark, sf_dir).rows())))


def offsets_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends of the log against the ends some groups have committed."""
    log = event_log(spark, sf_dir)
    ends = progress(log.rows())
    restored = decode_offsets(encode_offsets(ends))
    same = compare_offsets(ends, restored).select(F.lit("restored").alias("other"), "*")
    behind = compare_offsets(ends, groups_of(log).latest("g_full"))
    return same.unionByName(behind.select(F.lit("g_full").alias("other"), "*"))


def commit_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest position of every group; one of them was rewound."""
    latest = groups_of(event_log(spark, sf_dir)).latest()
    return latest.where(F.col("group_id").isin(*GROUPS))


def group_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions of a group after a batch of one topic and a repeated batch of all."""
    log = event_log(spark, sf_dir)
    starts = pin(_starts(log, "g_none", "smallest")).frame
    groups = GroupTable(spark, f"{scratch(spark)}/groups")
    unread = log.rows_after(starts)
    groups.commit_read("readers", "q1", 0, starts, subscribe(unread, ["click"]))
    groups.commit_read("readers", "q1", 1, starts, unread)
    groups.commit_read("readers", "q1", 1, starts, unread)
    return groups.commits("readers").select("group_id", "query_id", "batch_id", *KEY, "last_offset")


# --- broker rows ---


def broker_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with the columns of Spark's broker source, as envelopes."""
    return readable(from_broker(_broker_shaped(event_log(spark, sf_dir).rows())))


def _broker_shaped(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("_key").alias("key"),
        F.col("_message").alias("value"),
        F.col("_topic").alias("topic"),
        F.col("_partition").alias("partition"),
        F.col("_offset").alias("offset"),
        F.lit("2024-01-01").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def broker_group_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of broker rows that goes on from a group, commits batch by batch, and is started twice.

    Its files come in three parts, the middle one last, so the position waits for it.
    """
    log, out = event_log(spark, sf_dir), scratch(spark)
    shaped = _broker_shaped(subscribe(log.rows(), TOPICS))
    ends = subscribe(log.partitions(), TOPICS).select(F.col("_topic").alias("topic"), F.col("_partition").alias("partition"), "latest")
    dealt = shaped.join(F.broadcast(ends), ["topic", "partition"]).withColumn("part", F.expr("offset * 3 div latest"))
    groups = GroupTable(spark, f"{out}/groups")
    groups.commit("readers", "earlier", 0, halfway(subscribed(log)))
    starts = freeze_starts(spark, f"{out}/starts", lambda: resolve_starts(subscribed(log), groups.latest("readers"), "smallest"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/rows/batch_id={batch_id}")

    def run() -> None:
        stream = spark.readStream.schema(shaped.schema).option("maxFilesPerTrigger", 4).parquet(f"{out}/broker")
        start_grouped(
            from_broker(stream), starts, sink,
            groups=groups, group_id="readers", checkpoint=f"{out}/checkpoint", state=f"{out}/state", trigger={"availableNow": True},
        ).awaitTermination()

    for part in (0, 2, 1):
        dealt.where(F.col("part") == part).select(*shaped.columns).write.mode("append").parquet(f"{out}/broker")
    run()
    run()
    rows = spark.read.parquet(f"{out}/rows").groupBy(*KEY).agg(F.min("_offset").alias("first"), F.count("*").alias("records"))
    return groups.latest("readers").join(rows, KEY).select(*KEY, "first", "records", "last_offset")


# --- streams ---


def _topics(log: TopicLog) -> list[str]:
    return [row._topic for row in log.partitions().select("_topic").distinct().collect()]


def _topiclog_stream(log: TopicLog, group: str, reset: str) -> DataFrame:
    register(log.spark)
    return (
        log.spark.readStream.format("topiclog")
        .option("topics", ",".join(_topics(log)))
        .option("group.id", group)
        .option("auto.offset.reset", reset)
        .option("commit", "false")
        .load(log.root)
    )


def _drain(stream: DataFrame, out: str) -> None:
    """Append everything available to ``out/rows`` and stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{out}/rows")
    )
    query.awaitTermination()


def stream_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, out = event_log(spark, sf_dir), scratch(spark)
    _drain(_topiclog_stream(log, "g_stream", "smallest"), out)
    return readable(to_envelope(spark.read.parquet(f"{out}/rows")))


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log that grows in three appends, read by three runs on one checkpoint."""
    records, out = event_records(spark, sf_dir), scratch(spark)
    log = TopicLog(spark, f"{out}/log")
    for cut in event_cuts(records):
        log.append(event_slice(records, cut), "event_id")
        _drain(_topiclog_stream(log, "g_stream", "smallest"), out)
    return readable(to_envelope(spark.read.parquet(f"{out}/rows")))


def scan_stream_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch read of what a stream has not read, from where its checkpoint stands."""
    records, out = event_records(spark, sf_dir), scratch(spark)
    log = TopicLog(spark, f"{out}/log")
    first, second, third = event_cuts(records)
    log.append(event_slice(records, first), "event_id")
    _drain(_topiclog_stream(log, "g_stream", "smallest"), out)
    for cut in (second, third):
        log.append(event_slice(records, cut), "event_id")
    return readable(log.resume(_topics(log), checkpoint_starts(spark, f"{out}/checkpoint")))


def stream_native_growing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log that grows in three appends, the second of them after one that failed half-way, read natively by three runs."""
    records, out = event_records(spark, sf_dir), scratch(spark)
    log = TopicLog(spark, f"{out}/log")

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/rows/batch_id={batch_id}")

    for no, cut in enumerate(event_cuts(records)):
        if no == 1:
            log.rows().write.partitionBy(*KEY).parquet(f"{log.data_path}/_append=1")
        log.append(event_slice(records, cut), "event_id")
        starts = freeze_starts(spark, f"{out}/starts", lambda: log.partitions().select(*KEY, F.col("earliest").alias("next_offset")))
        query = start_committing(
            log, _topics(log), starts, sink,
            group_id="g_growing", checkpoint=f"{out}/checkpoint", trigger={"availableNow": True}, new_partitions=True,
        )
        query.awaitTermination()
    return readable(to_envelope(spark.read.parquet(f"{out}/rows")))


def _native(spark: SparkSession, sf_dir: str, out: str, group: str) -> TopicLog:
    log = event_log(spark, sf_dir)
    starts = freeze_starts(spark, f"{out}/starts", lambda: _starts(log, "g_none", "smallest"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/rows/batch_id={batch_id}")

    query = start_committing(
        log,
        TOPICS,
        starts,
        sink,
        group_id=group,
        checkpoint=f"{out}/checkpoint",
        trigger={"availableNow": True},
        max_files_per_trigger=10_000,
    )
    query.awaitTermination()
    return log


def stream_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch(spark)
    _native(spark, sf_dir, out, "g_native_rows")
    return readable(to_envelope(spark.read.parquet(f"{out}/rows")))


def stream_native_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _native(spark, sf_dir, scratch(spark), "g_native")
    return groups_of(log).latest("g_native").select(*KEY, "last_offset")


def resume_and_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: discover, resume a group, scan what it has not read, decode."""
    log = event_log(spark, sf_dir)
    unread = log.rows_after(_starts(log, "g_full", "largest"))
    return unread.where(~is_tombstone()).select(
        *KEY, "_offset", text("_key").alias("user_id"), json_field("$.k", "bigint").alias("k")
    )


QUERIES: dict[str, Query] = {
    "resume_and_decode": resume_and_decode,
    "source_scan": source_scan,
    "renamed_columns": renamed_columns,
    "topic_subset": topic_subset,
    "offset_range_filter": offset_range_filter,
    "tombstones": tombstones,
    "keyless_records": keyless_records,
    "decode_payload": decode_payload,
    "partition_discovery": partition_discovery,
    "partition_discovery_records": partition_discovery_records,
    "start_group_full_smallest": _start_query("g_full", "smallest"),
    "start_group_full_largest": _start_query("g_full", "largest"),
    "start_group_partial_smallest": _start_query("g_partial", "smallest"),
    "start_group_partial_largest": _start_query("g_partial", "largest"),
    "start_group_none_smallest": _start_query("g_none", "smallest"),
    "start_group_none_largest": _start_query("g_none", "largest"),
    "scan_group_full": _scan_query("g_full", "largest"),
    "scan_group_rewind": _scan_query("g_rewind", "largest"),
    "scan_group_partial_smallest": _scan_query("g_partial", "smallest"),
    "scan_group_none_smallest": _scan_query("g_none", "smallest"),
    "scan_checkpoint": scan_checkpoint,
    "scan_task_ranges": scan_task_ranges,
    "missing_starts": missing_starts,
    "source_batch_filtered": source_batch_filtered,
    "offset_gaps": offset_gaps,
    "append_continues": append_continues,
    "read_progress": read_progress,
    "merge_offsets_idle": merge_offsets_idle,
    "offsets_json": offsets_json,
    "offsets_json_document": offsets_json_document,
    "offsets_json_roundtrip": offsets_json_roundtrip,
    "offsets_equality": offsets_equality,
    "commit_latest": commit_latest,
    "group_commit": group_commit,
    "broker_projection": broker_projection,
    "broker_group_commit": broker_group_commit,
    "stream_available_now": stream_available_now,
    "stream_resume": stream_resume,
    "scan_stream_checkpoint": scan_stream_checkpoint,
    "stream_native": stream_native,
    "stream_native_growing": stream_native_growing,
    "stream_native_commit": stream_native_commit,
}
