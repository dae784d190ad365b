"""Streaming a topic log inside the JVM: the stream follows the manifest, whose rows name the files to read.

A manifest becomes visible at once, when its append is complete, so a half-written append is never read. A batch reads
everything between the append that the batch before has reached and the newest one it was handed, whatever the order in which
the file source lists them; batches follow the order of offsets. Positions come from the manifest alone: the
records of a batch are read once, by the sink.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators.envelope import subscribe
from tidelog.operators.pin import pin
from tidelog.operators.progress import merge_offsets
from tidelog.operators.starts import require_no_gaps, starts_after
from tidelog.schema import BATCH_STATE, KEY, MANIFEST, STARTS
from tidelog.sources.files import is_complete
from tidelog.sources.group_table import GroupTable
from tidelog.sources.log_table import TopicLog

Sink = Callable[[DataFrame, int], None]


def freeze_starts(spark: SparkSession, path: str, resolve: Callable[[], DataFrame]) -> DataFrame:
    """Starts of a query, resolved once and kept at ``path`` for every restart.

    Resolving again would drop records if the group has moved past the checkpoint.
    """
    if not is_complete(spark, path):
        resolve().select(*STARTS.names).coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.schema(STARTS).parquet(path)


def contiguous_offsets(starts: DataFrame, files: DataFrame) -> DataFrame:
    """``last_offset`` of every started partition after reading ``files`` (manifest rows); fails, naming it, if a range is missing."""
    require_no_gaps(files, starts)
    return merge_offsets(starts, files.groupBy(*KEY).agg(F.max("max_offset").alias("last_offset")))


class BatchState:
    """Where a query stands after a batch: its positions and the newest append that it has read.

    Each batch needs the state of the one before. A replayed batch overwrites its own state.
    """

    def __init__(self, spark: SparkSession, log: TopicLog, query_id: str):
        self.spark = spark
        self.path = f"{log.root}/progress/{query_id}"

    def load(self, batch_id: int, first: DataFrame) -> tuple[DataFrame, int]:
        """Starts of a batch, and the append read last; ``first`` begins the query."""
        if batch_id == 0:
            return first, -1
        previous = f"{self.path}/{batch_id - 1}"
        if not is_complete(self.spark, previous):
            raise ValueError(f"no position after batch {batch_id - 1}")
        state = self.spark.read.schema(BATCH_STATE).parquet(previous)
        done = state.agg(F.max("append")).first()[0]
        return state.select(*STARTS.names), -1 if done is None else done

    def save(self, batch_id: int, offsets: DataFrame, append: int) -> DataFrame:
        """Keep the state; returns the positions, read back."""
        path = f"{self.path}/{batch_id}"
        starts_after(offsets).withColumn("append", F.lit(append).cast("bigint")).write.mode("overwrite").parquet(path)
        state = self.spark.read.schema(BATCH_STATE).parquet(path)
        return state.select(*KEY, (F.col("next_offset") - 1).alias("last_offset"))


def _with_new_partitions(files: DataFrame, starts: DataFrame, allowed: bool) -> DataFrame:
    """Starts extended by partitions that ``files`` are the first of; these are an error unless ``allowed``."""
    born = files.join(starts, KEY, "left_anti").groupBy(*KEY).agg(F.min("min_offset").alias("next_offset"))
    first = born.orderBy(*KEY).limit(5).collect()
    if not first:
        return starts
    if not allowed:
        names = ", ".join(f"{row._topic}/{row._partition}" for row in first)
        raise ValueError(f"partition has no start offset: {names} ({born.count()} in all)")
    return pin(starts.unionByName(born)).frame


def start_committing(
    log: TopicLog,
    topics: Sequence[str],
    starts: DataFrame,
    sink: Sink,
    *,
    group_id: str,
    checkpoint: str,
    trigger: dict,
    groups: GroupTable | None = None,
    commit: bool = True,
    new_partitions: bool = False,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Run ``sink`` on the records of each batch, then commit the group's position.

    ``max_files_per_trigger`` counts appends, as each has one manifest file. A partition without a start is an
    error, or with ``new_partitions`` read from its beginning; so is a hole in the offsets. A batch whose commit
    fails is failed and replayed, so ``sink`` must accept the same ``batch_id`` again. Delivery to the group is at least once.
    """
    table = log.groups_path if groups is None else groups.path
    starts = pin(starts).frame

    def on_batch(manifests: DataFrame, batch_id: int) -> None:
        spark = manifests.sparkSession
        here = TopicLog(spark, log.root)
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        state = BatchState(spark, here, query_id)
        before, done = state.load(batch_id, starts)
        newest = manifests.agg(F.max("_append")).first()[0]
        upto = done if newest is None else max(done, newest)
        files = pin(subscribe(here.manifest(after=done, upto=upto), topics)).frame
        before = _with_new_partitions(files, before, new_partitions)
        offsets = contiguous_offsets(before, files)
        sink(here.rows_after(before, files), batch_id)
        offsets = state.save(batch_id, offsets, upto)
        if commit:
            GroupTable(spark, table).commit(group_id, query_id, batch_id, offsets)

    reader = log.spark.readStream.schema(MANIFEST)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(log.manifest_path)
    return (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
