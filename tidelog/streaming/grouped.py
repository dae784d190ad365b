"""Group positions of any stream of envelopes, from the offsets that it returns.

Streams of live brokers and of files know no manifest. What has been read is kept as runs of offsets per partition and carried
from batch to batch: the group's position is the end of the run that begins at its start, and runs beyond a hole wait until
the hole has been read. State and commits are keyed by batch, so a replayed batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators.pin import pin
from tidelog.operators.runs import consumed_before, holes, merge_runs, offset_runs, reached
from tidelog.operators.scan import after_starts
from tidelog.schema import KEY, RUNS
from tidelog.sources.files import is_complete
from tidelog.sources.group_table import GroupTable

Sink = Callable[[DataFrame, int], None]
#: What a hole does: the position waits before it, the batch fails, or the position moves past it (compacted topics).
HOLES = ("hold", "fail", "skip")


def _named(rows: DataFrame, problem: str) -> str:
    found = rows.orderBy(*KEY, *(c for c in ("first",) if c in rows.columns)).limit(5).collect()
    ranges = [f"{r._topic}/{r._partition}" + (f": offsets {r['first']} to {r['last']}" if "first" in r else "") for r in found]
    return f"{'; '.join(ranges)} {problem} ({rows.count()} in all)"


def advance(before: DataFrame, batch: DataFrame, on_holes: str = "hold") -> DataFrame:
    """Merged runs after a ``batch`` of records, from the runs ``before`` it."""
    runs = merge_runs(before.unionByName(offset_runs(batch)))
    if on_holes == "skip":
        return runs.groupBy(*KEY).agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return runs


class RunState:
    """Runs after each batch of a query; a replayed batch overwrites its own."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def load(self, batch_id: int, starts: DataFrame) -> DataFrame:
        if batch_id == 0:
            return consumed_before(starts)
        previous = f"{self.path}/{batch_id - 1}"
        if not is_complete(self.spark, previous):
            raise ValueError(f"no position after batch {batch_id - 1}")
        return self.spark.read.schema(RUNS).parquet(previous)

    def save(self, batch_id: int, runs: DataFrame) -> DataFrame:
        path = f"{self.path}/{batch_id}"
        runs.select(*RUNS.names).write.mode("overwrite").parquet(path)
        return self.spark.read.schema(RUNS).parquet(path)


def start_grouped(
    stream: DataFrame,
    starts: DataFrame,
    sink: Sink,
    *,
    groups: GroupTable,
    group_id: str,
    checkpoint: str,
    state: str,
    trigger: dict,
    new_partitions: bool = False,
    on_holes: str = "hold",
) -> StreamingQuery:
    """Run ``sink`` on the records of each batch past ``starts``, then commit the group's position.

    ``starts`` has one row per partition, usually of ``groups.latest`` or of ``resolve_starts``, and must be the same at every
    restart (see ``freeze_starts``). A partition without a start fails the batch, or with ``new_partitions`` is read
    from offset 0. ``state`` is a folder for what has been read. The batch is kept while it is read twice, as brokers are
    slow to ask again. Delivery to the group is at least once.
    """
    if on_holes not in HOLES:
        raise ValueError(f"on_holes must be one of {', '.join(HOLES)}")
    pinned = pin(starts)
    first = pinned.frame

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        kept = RunState(spark, f"{state.rstrip('/')}/{query_id}")
        before = kept.load(batch_id, first)
        batch = batch.persist()
        try:
            sink(batch, batch_id)
            if new_partitions:
                known = before.select(*KEY).distinct()
                born = batch.select(*KEY).distinct().join(known, KEY, "left_anti")
                before = before.unionByName(consumed_before(born.withColumn("next_offset", F.lit(0).cast("bigint"))))
            runs = kept.save(batch_id, advance(before, batch, on_holes))
        finally:
            batch.unpersist()
        if on_holes == "fail":
            missing = holes(runs)
            if not missing.isEmpty():
                raise ValueError(_named(missing, "are missing"))
        groups_here = GroupTable(spark, groups.path)
        groups_here.commit(group_id, query_id, batch_id, reached(runs))

    records = after_starts(stream, pinned, new_partitions=new_partitions, required=not new_partitions)
    return (
        records.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )
