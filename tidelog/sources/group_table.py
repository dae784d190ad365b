"""Committed consumer-group positions as a table.

Layout: ``group_id=<g>/query_id=<q>/batch_id=<n>/*.parquet``, and ``_order``, see ``group_log``. A replayed batch
overwrites its own directory, so commits are idempotent. ``committed_at`` orders
the commits of different queries.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.pin import pin
from tidelog.operators.progress import merge_offsets, progress
from tidelog.schema import GROUP_OFFSETS, KEY
from tidelog.sources.files import children, directory, exists, file_names, touch
from tidelog.sources.group_log import ORDER, Marker, decisive, microseconds, parse_markers


class GroupTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def commits(self, group_id: str | None = None) -> DataFrame:
        """Every commit, of one group if named (all groups are listed, only its files are read)."""
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], GROUP_OFFSETS)
        table = self.spark.read.schema(GROUP_OFFSETS).parquet(self.path).select(*GROUP_OFFSETS.names)
        return table if group_id is None else table.where(F.col("group_id") == group_id)

    def _folders(self, group: str) -> list[str]:
        """Folders of the commits that hold a group's newest positions."""
        names = file_names(self.spark, f"{self.path}/{ORDER}/{group}")
        return [f"{self.path}/{group}/{marker.folder}" for marker in decisive(parse_markers(names))]

    def latest(self, group_id: str | None = None) -> DataFrame:
        """``group_id, _topic, _partition, last_offset`` of the newest commit.

        Newest, not largest: a group may be rewound. Of a group's history only the commits back to
        the newest complete one are opened; ``max_by`` combines map-side.
        """
        if group_id is not None:
            groups = [directory("group_id", group_id)]
        else:
            groups = [name for name in children(self.spark, f"{self.path}/{ORDER}") if name.startswith("group_id=")]
        folders = [folder for group in groups for folder in self._folders(group)]
        if not folders:
            commits = self.spark.createDataFrame([], GROUP_OFFSETS)
        else:
            commits = self.spark.read.schema(GROUP_OFFSETS).option("basePath", self.path).parquet(*folders)
        newest = F.struct("committed_at", "batch_id", "query_id")
        return commits.groupBy("group_id", *KEY).agg(F.max_by("last_offset", newest).alias("last_offset"))

    def commit(
        self,
        group_id: str,
        query_id: str,
        batch_id: int,
        offsets: DataFrame,
        committed_at: datetime | None = None,
    ) -> bool:
        """Store ``_topic, _partition, last_offset``; False if the group is already there."""
        # Pinned, so that the records behind the offsets are read once.
        offsets = pin(offsets.select(*KEY, "last_offset")).frame
        known = pin(self.latest(group_id).select(*KEY, "last_offset")).frame
        if offsets.join(known, [*KEY, "last_offset"], "left_anti").isEmpty():
            return False
        complete = known.join(offsets, KEY, "left_anti").isEmpty()
        when = committed_at or datetime.now(timezone.utc)
        marker = Marker(microseconds(when), batch_id, query_id, complete, "0")
        rows = offsets.select(
            F.lit(group_id).alias("group_id"),
            F.lit(query_id).alias("query_id"),
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            F.lit(when).alias("committed_at"),
            *KEY,
            "last_offset",
        )
        # One row per partition: a single small file per commit.
        (
            rows.coalesce(1)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("group_id", "query_id", "batch_id")
            .parquet(self.path)
        )
        touch(self.spark, f"{self.path}/{ORDER}/{directory('group_id', group_id)}/{marker.name}")
        return True

    def commit_read(
        self, group_id: str, query_id: str, batch_id: int, starts: DataFrame, records: DataFrame
    ) -> bool:
        """Commit the positions that reading ``records`` from ``starts`` has reached."""
        reached = merge_offsets(starts, progress(records))
        return self.commit(group_id, query_id, batch_id, reached)
