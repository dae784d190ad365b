"""Which files a read of a topic log has to open, and how they are dealt out to tasks.

Runs inside the Python source, without a session. What it reads is bounded by what is unread: the positions come from the
heads of the newest append (one row per topic-partition), and the manifests of appends are followed backwards from there,
partition by partition, only until one reaches below the start.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyspark.sql.datasource import InputPartition

from tidelog.sources.files import arrow_children, numbers, open_arrow

#: ``{topic: {partition as text: offset}}``, the shape Spark stores as JSON.
Offsets = dict[str, dict[str, int]]
Partition = tuple[str, str]


@dataclass(frozen=True)
class Range:
    """Offsets ``[start, end)`` of one topic-partition, and the file that holds them."""

    topic: str
    partition: int
    start: int
    end: int
    file: str


@dataclass
class ScanTask(InputPartition):
    """Ranges that one task reads, in order."""

    ranges: list[Range]


class Span:
    """Files of one topic-partition in one append, by offset: parallel arrays, searched by bisection."""

    def __init__(self, table: pa.Table):
        self.low = table["min_offset"].to_numpy()
        self.high = table["max_offset"].to_numpy() + 1
        self.rows = table["rows"].to_numpy()
        self.previous = table["previous"][0].as_py()
        self.table = table

    def reaching(self, start: int, end: int) -> range:
        return range(int(np.searchsorted(self.high, start, "right")), int(np.searchsorted(self.low, end, "left")))


class LogIndex:
    """Positions and unread files of the subscribed topics of a log."""

    def __init__(self, path: str, topics: Iterable[str]):
        self.path = path
        self.topics = list(topics)
        self.newest = -1
        self.earliest: Offsets = {}
        self.latest: Offsets = {}
        self.last_append: Offsets = {}
        #: By append, as long as a start lies in or before it: files of each topic-partition.
        self.appends: dict[int, dict[Partition, Span]] = {}
        self.rows_read = 0

    def _table(self, kind: str, number: int) -> pa.Table:
        filesystem, base = open_arrow(f"{self.path}/{kind}/_append={number}")
        wanted = ds.field("_topic").isin(self.topics)
        table = ds.dataset(base, filesystem=filesystem, format="parquet").to_table(filter=wanted)
        self.rows_read += table.num_rows
        return table

    def refresh(self) -> None:
        """Take in the newest complete append: a row per topic-partition, whatever the number of appends since."""
        folder = f"{self.path}/manifest"
        for number in reversed(numbers(arrow_children(folder), "_append")):
            if number <= self.newest:
                break
            if any(name.endswith(".parquet") for name in arrow_children(f"{folder}/_append={number}")):
                self._take_heads(number)
                break
        unknown = [topic for topic in self.topics if not self.latest.get(topic)]
        if unknown:
            raise ValueError(f"no partition found for topic(s): {', '.join(unknown)}")

    def _take_heads(self, number: int) -> None:
        heads = self._table("heads", number)
        columns = (heads[c].to_pylist() for c in ("_topic", "_partition", "earliest", "latest", "append"))
        self.earliest, self.latest, self.last_append = ({topic: {} for topic in self.topics} for _ in range(3))
        for topic, partition, earliest, latest, append in zip(*columns):
            self.earliest[topic][str(partition)] = earliest
            self.latest[topic][str(partition)] = latest
            self.last_append[topic][str(partition)] = append
        self.newest = number

    def _spans(self, number: int) -> dict[Partition, Span]:
        if number not in self.appends:
            table = self._table("manifest", number)
            order = [("_topic", "ascending"), ("_partition", "ascending"), ("min_offset", "ascending")]
            table = table.sort_by(order).combine_chunks()
            keys = list(zip(table["_topic"].to_pylist(), map(str, table["_partition"].to_pylist())))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            self.appends[number] = {keys[a]: Span(table.slice(a, b - a)) for a, b in zip(cuts, cuts[1:]) if b > a}
        return self.appends[number]

    def unread(self, start: Offsets, end: Offsets) -> Iterator[tuple[Partition, int, int, list[Span]]]:
        """Topic-partitions with records in ``[start, end)``, and the spans that hold them, oldest first."""
        used: set[int] = set()
        for topic in sorted(end):
            for partition in sorted(end[topic], key=int):
                first, stop = start[topic][partition], end[topic][partition]
                if first >= stop:
                    continue
                found: list[Span] = []
                number = self.last_append[topic][partition]
                while number >= 0:
                    span = self._spans(number)[topic, partition]
                    used.add(number)
                    if span.low[0] < stop:
                        found.append(span)
                    if span.low[0] <= first:
                        break
                    number = span.previous
                yield (topic, partition), first, stop, found[::-1]
        # Appends that no start lies before any more are not kept.
        self.appends = {number: self.appends[number] for number in used}

    def tasks(self, start: Offsets, end: Offsets, rows_per_task: int, bytes_per_task: int) -> list[ScanTask]:
        """Tasks of similar size that read ``[start, end)``; fails if a record in between is in no file."""
        return list(packed(self._pieces(start, end, rows_per_task), rows_per_task, bytes_per_task))

    def _pieces(self, start: Offsets, end: Offsets, rows_per_task: int) -> Iterator[tuple[Range, float]]:
        for (topic, partition), first, stop, spans in self.unread(start, end):
            upto = first
            for span in spans:
                for at in span.reaching(first, stop):
                    low, high = int(span.low[at]), int(span.high[at])
                    require_whole(topic, partition, upto, low, high, int(span.rows[at]))
                    upto = high
                    file = span.table["file"][at].as_py()
                    for begin, edge, weight in row_groups(span.table, at, low, high):
                        begin, edge = max(begin, first), min(edge, stop)
                        for piece in range(begin, edge, rows_per_task):
                            last = min(piece + rows_per_task, edge)
                            yield Range(topic, int(partition), piece, last, file), weight * (last - piece)
            if upto < stop:
                raise ValueError(missing(topic, partition, upto, stop))


def missing(topic: str, partition: str, first: int, stop: int) -> str:
    return f"{topic}/{partition}: offsets {first} to {stop - 1} are missing"


def require_whole(topic: str, partition: str, upto: int, low: int, high: int, rows: int) -> None:
    """Fail if records between ``upto`` and a file, or inside of it, are in no file."""
    if low > upto:
        raise ValueError(missing(topic, partition, upto, low))
    if rows != high - low:
        raise ValueError(missing(topic, partition, low, high).replace("are missing", "are incomplete"))


def row_groups(table: pa.Table, at: int, low: int, high: int) -> Iterator[tuple[int, int, float]]:
    """Offset range and bytes a record of each row group of a file; the whole file where its groups are not known."""
    rows, sizes = table["group_rows"][at].as_py(), table["group_bytes"][at].as_py()
    if not rows or sum(rows) != high - low:
        yield low, high, (table["bytes"][at].as_py() or 0) / max(1, high - low)
        return
    for count, size in zip(rows, sizes):
        yield low, low + count, size / max(1, count)
        low += count


def packed(pieces: Iterable[tuple[Range, float]], rows_per_task: int, bytes_per_task: int) -> Iterator[ScanTask]:
    """Deal pieces out in order: a task is closed when the next piece would exceed the rows or bytes of a task.

    Neighbouring pieces of one file become one range, so a file is opened once by a task.
    """
    ranges: list[Range] = []
    rows, size = 0, 0.0
    for piece, weight in pieces:
        count = piece.end - piece.start
        if ranges and (rows + count > rows_per_task or size + weight > bytes_per_task):
            yield ScanTask(ranges)
            ranges, rows, size = [], 0, 0.0
        last = ranges[-1] if ranges else None
        if last and last.file == piece.file and last.end == piece.start:
            ranges[-1] = Range(piece.topic, piece.partition, last.start, piece.end, piece.file)
        else:
            ranges.append(piece)
        rows, size = rows + count, size + weight
    if ranges:
        yield ScanTask(ranges)


def read_ranges(path: str, task: ScanTask) -> Iterator[pa.RecordBatch]:
    """Envelope batches of a task's ranges."""
    filesystem, base = open_arrow(path)
    for part in task.ranges:
        wanted = (ds.field("_offset") >= part.start) & (ds.field("_offset") < part.end)
        data = ds.dataset(f"{base}/data/{part.file}", filesystem=filesystem, format="parquet")
        # The filter skips row groups by their statistics before rows are decoded. Small
        # batches and little read-ahead keep a task's memory low when payloads are large.
        batches = data.to_batches(
            columns=["_key", "_message", "_offset"],
            filter=wanted,
            batch_size=8192,
            batch_readahead=2,
            fragment_readahead=1,
            use_threads=False,
        )
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [
                        pc.cast(batch.column("_key"), pa.binary()),
                        pc.cast(batch.column("_message"), pa.binary()),
                        pa.repeat(pa.scalar(part.topic, pa.string()), batch.num_rows),
                        pa.repeat(pa.scalar(part.partition, pa.int32()), batch.num_rows),
                        batch.column("_offset"),
                    ],
                    names=["_key", "_message", "_topic", "_partition", "_offset"],
                )
