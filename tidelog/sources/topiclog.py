"""``spark.read`` and ``spark.readStream`` of ``format("topiclog")``: exact offset ranges of a topic log.

Offsets are ``{topic: {partition: next_offset}}``. Planning reads only metadata
(heads, manifests and group table); records are read in the tasks as Arrow batches.
"""

from __future__ import annotations

import copy
import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import replace
from datetime import datetime, timezone

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.types import StructType

import tidelog
from tidelog.options import SMALLEST, ReadOptions, lowered
from tidelog.schema import ENVELOPE
from tidelog.sources.files import default_file_system, on_file_system
from tidelog.sources.group_log import GroupLog
from tidelog.sources.planning import LogIndex, Offsets, ScanTask, read_ranges


class TopicLogSource(DataSource):
    #: Where paths without a scheme lie; set from the session when the source is registered.
    file_system = "file:///"

    def __init__(self, options):
        super().__init__(options)
        given = lowered(options)
        settings = ReadOptions.parse(options)
        self.settings = replace(settings, path=on_file_system(settings.path, self.file_system))
        # A batch ends at the end of the log, so it begins at the first record unless told otherwise.
        self.batch_settings = self.settings if "auto.offset.reset" in given else replace(self.settings, reset=SMALLEST)

    @classmethod
    def name(cls) -> str:
        return "topiclog"

    def schema(self) -> StructType:
        return ENVELOPE

    def _check(self, schema: StructType) -> None:
        wanted = [(f.name, f.dataType) for f in schema.fields]
        if wanted != [(f.name, f.dataType) for f in ENVELOPE.fields]:
            raise ValueError(f"the schema is fixed: {ENVELOPE.simpleString()}")

    def reader(self, schema: StructType) -> DataSourceReader:
        self._check(schema)
        return TopicLogReader(self.batch_settings)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        self._check(schema)
        return TopicLogStreamReader(self.settings)


class _Planner:
    """Positions and tasks of a read; on the driver."""

    def __init__(self, settings: ReadOptions):
        self.settings = settings
        self.index = LogIndex(settings.path, settings.topics)
        self.groups = GroupLog(f"{settings.path}/groups")

    def _initial(self) -> Offsets:
        """Given offsets, else group positions if they cover every partition, else the reset policy."""
        self.index.refresh()
        if self.settings.starting_offsets:
            return json.loads(self.settings.starting_offsets)
        latest = self.index.latest
        committed = self.groups.newest(self.settings.group_id)
        if all(p in committed.get(topic, {}) for topic, parts in latest.items() for p in parts):
            return {t: {p: committed[t][p] + 1 for p in parts} for t, parts in latest.items()}
        return copy.deepcopy(self.index.earliest if self.settings.reset == SMALLEST else latest)

    def _checked(self, start: Offsets, end: Offsets) -> Offsets:
        """``start`` of every partition in ``end``; fails if one cannot be read from there."""
        for topic, parts in start.items():
            for partition in parts:
                if partition not in end.get(topic, {}):
                    raise ValueError(f"{topic}/{partition}: partition is gone from the log")
        return {
            topic: {partition: self._checked_start(topic, partition, start, stop) for partition, stop in parts.items()}
            for topic, parts in end.items()
        }

    def _checked_start(self, topic: str, partition: str, start: Offsets, stop: int) -> int:
        name = f"{topic}/{partition}"
        earliest = self.index.earliest.get(topic, {}).get(partition)
        if earliest is None:
            raise ValueError(f"{name}: partition is gone from the log")
        first = start.get(topic, {}).get(partition)
        if first is None:
            if self.settings.on_new_partition == "fail":
                raise ValueError(f"{name}: partition has no start offset")
            first = earliest
        if first > stop:
            raise ValueError(f"{name}: start offset lies beyond the end of the log")
        if first < earliest:
            raise ValueError(f"{name}: records before the earliest are gone")
        if stop > self.index.latest[topic][partition]:
            raise ValueError(f"{name}: the log ends before the planned offset")
        return first

    def _tasks(self, start: Offsets, end: Offsets) -> list[ScanTask]:
        return self.index.tasks(start, end, self.settings.rows_per_task, self.settings.bytes_per_task)


class TopicLogReader(_Planner, DataSourceReader):
    """Everything from the start position to the end of the log; predicates on the position narrow what is planned."""

    def __init__(self, settings: ReadOptions):
        super().__init__(settings)
        self.topics: set[str] = set(settings.topics)
        self.partition_numbers: set[int] | None = None
        self.low, self.high = 0, 2**63 - 1

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Take over predicates on topic, partition and offset; Spark evaluates the others."""
        for given in filters:
            if not self._taken(given):
                yield given

    def _taken(self, given: Filter) -> bool:
        column = getattr(given, "attribute", None)
        if column is None or len(column) != 1:
            return False
        name, value = column[0], getattr(given, "value", None)
        if isinstance(given, IsNotNull):
            return name in ("_topic", "_partition", "_offset")  # never null
        if isinstance(given, (EqualTo, In)) and name in ("_topic", "_partition"):
            values = set(value) if isinstance(given, In) else {value}
            if name == "_topic":
                self.topics &= values
            else:
                self.partition_numbers = values if self.partition_numbers is None else self.partition_numbers & values
            return True
        if name != "_offset" or value is None:
            return False
        if isinstance(given, EqualTo):
            self.low, self.high = max(self.low, value), min(self.high, value + 1)
        elif isinstance(given, (GreaterThan, GreaterThanOrEqual)):
            self.low = max(self.low, value + isinstance(given, GreaterThan))
        elif isinstance(given, (LessThan, LessThanOrEqual)):
            self.high = min(self.high, value + isinstance(given, LessThanOrEqual))
        else:
            return False
        return True

    def _wanted(self, topic: str, partition: str) -> bool:
        return topic in self.topics and (self.partition_numbers is None or int(partition) in self.partition_numbers)

    def partitions(self) -> list[ScanTask]:
        start = self._initial()
        start = self._checked(start, self.index.latest)  # every start is checked, also of partitions that are filtered out
        narrowed: Offsets = {}
        ends: Offsets = {}
        for topic, parts in start.items():
            for partition, first in parts.items():
                if self._wanted(topic, partition):
                    stop = min(self.high, self.index.latest[topic][partition])
                    narrowed.setdefault(topic, {})[partition] = max(first, self.low)
                    ends.setdefault(topic, {})[partition] = stop
        return self._tasks(narrowed, ends)

    def read(self, task: ScanTask | None) -> Iterator[pa.RecordBatch]:
        # Spark hands on no task where none was planned.
        return iter(()) if task is None else read_ranges(self.settings.path, task)


class TopicLogStreamReader(_Planner, DataSourceStreamReader):
    def __init__(self, settings: ReadOptions):
        super().__init__(settings)
        self.writer = uuid.uuid4().hex
        self.last_commit: Offsets | None = None
        #: Whether this process began the stream, rather than going on from a checkpoint.
        self.began = False

    def initialOffset(self) -> Offsets:
        self.began = True
        return self._initial()

    def latestOffset(self) -> Offsets:
        self.index.refresh()
        return copy.deepcopy(self.index.latest)

    def partitions(self, start: Offsets, end: Offsets) -> list[ScanTask]:
        self.index.refresh()
        return self._tasks(self._checked(start, end), end)

    def commit(self, end: Offsets) -> None:
        """Store consumed positions for the group, unless it is already there.

        Spark calls this when the following batch is planned, so the group may lag
        one batch behind the checkpoint but never runs ahead of the sink. After a
        restart Spark repeats the last call. If the group has held these very positions
        before, the repeat is left out, so that it does not overrule a rewind since then.
        """
        if not self.settings.commit:
            return
        consumed = {t: {p: offset - 1 for p, offset in parts.items()} for t, parts in end.items()}
        repeated = self.last_commit is None and not self.began and self.groups.held(self.settings.group_id, consumed)
        known = self.groups.newest(self.settings.group_id) if self.last_commit is None else self.last_commit
        same = all(known.get(t, {}).get(p) == last for t, parts in consumed.items() for p, last in parts.items())
        if not same and not repeated:
            self.groups.commit(self.settings.group_id, f"source-{self.writer}", consumed, datetime.now(timezone.utc))
        self.last_commit = consumed

    def read(self, task: ScanTask) -> Iterator[pa.RecordBatch]:
        return read_ranges(self.settings.path, task)


def register(spark: SparkSession) -> None:
    """Make ``format("topiclog")`` known to the session, and let Spark hand it predicates.

    The source travels to the workers by value, so they need not have the package.
    """
    TopicLogSource.file_system = default_file_system(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    cloudpickle.register_pickle_by_value(tidelog)
    try:
        spark.dataSource.register(TopicLogSource)
    finally:
        cloudpickle.unregister_pickle_by_value(tidelog)
