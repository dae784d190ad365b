"""A topic log as parquet files plus a manifest.

Layout below ``root``::

    data/_append=<n>/_topic=<t>/_partition=<p>/*.parquet   _key, _message, _offset
    heads/_append=<n>/*.parquet                            one row per topic-partition so far
    manifest/_append=<n>/*.parquet                         one row per data file, in one file
    groups/                                                consumer positions

Each data file covers one contiguous offset range, sorted. An append is visible
once the one file of its manifest has its name, which is the last step and happens at
once; a failed one is overwritten by its retry. Appends are made by one writer at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import tidelog

from tidelog.operators.discovery import discover_topics
from tidelog.operators.envelope import to_envelope
from tidelog.operators.numbering import CHUNK_BITS, number_offsets
from tidelog.operators.pin import Pinned, pin
from tidelog.operators.scan import after_starts
from tidelog.operators.starts import add_new_partitions, require_no_gaps, require_starts
from tidelog.schema import DATA_FILES, ENVELOPE, HEADS, KEY, MANIFEST
from tidelog.sources.files import children, default_file_system, numbers, on_file_system, open_arrow

#: Aim for the length of a data file; halve it for payloads far above a kilobyte.
ROWS_PER_FILE = 1_000_000


def _relative(file_path: str) -> Column:
    """Path below ``data/`` of a URL-encoded absolute path."""
    # A literal plus must survive decoding.
    path = F.url_decode(F.replace(F.col(file_path), F.lit("+"), F.lit("%2B")))
    return F.regexp_extract(path, r"(_append=\d+/_topic=.*)$", 1)


def _with_row_groups(data_path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files with rows and bytes of their row groups, from their footers; null where Arrow cannot open the place."""
    for batch in batches:
        rows, sizes = [], []
        for name in batch.column("file").to_pylist():
            try:
                filesystem, base = open_arrow(data_path)
                footer = pq.read_metadata(f"{base}/{name}", filesystem=filesystem)
                groups = [footer.row_group(i) for i in range(footer.num_row_groups)]
                rows.append([g.num_rows for g in groups])
                sizes.append([sum(g.column(i).total_compressed_size for i in range(g.num_columns)) for g in groups])
            except (OSError, pa.ArrowInvalid, pa.ArrowNotImplementedError):
                rows.append(None)
                sizes.append(None)
        kind = pa.list_(pa.int64())
        columns = [*batch.columns, pa.array(rows, kind), pa.array(sizes, kind)]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "group_rows", "group_bytes"])


class TopicLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = on_file_system(root.rstrip("/"), default_file_system(spark))
        self.data_path = f"{self.root}/data"
        self.manifest_path = f"{self.root}/manifest"
        self.groups_path = f"{self.root}/groups"

    def last_append(self) -> int:
        """Number of the newest complete append, -1 for an empty log."""
        for number in reversed(numbers(children(self.spark, self.manifest_path), "_append")):
            if any(name.endswith(".parquet") for name in children(self.spark, f"{self.manifest_path}/_append={number}")):
                return number
        return -1

    def manifest(self, after: int = -1, upto: int | None = None) -> DataFrame:
        """One row per visible data file, of the appends past ``after`` and up to ``upto``."""
        last = self.last_append() if upto is None else upto
        if last < 0:
            return self.spark.createDataFrame([], MANIFEST)
        files = self.spark.read.schema(MANIFEST).parquet(self.manifest_path)
        return files.where((F.col("_append") > after) & (F.col("_append") <= last))

    def heads(self, number: int | None = None) -> DataFrame:
        """``_topic, _partition, earliest, latest, append`` after an append, by default the newest."""
        number = self.last_append() if number is None else number
        if number < 0:
            return self.spark.createDataFrame([], HEADS)
        return self.spark.read.schema(HEADS).parquet(f"{self.root}/heads/_append={number}")

    def partitions(self) -> DataFrame:
        """``_topic, _partition, earliest, latest``, from one row per topic-partition whatever the log's age."""
        return self.heads().drop("append")

    def rows(self) -> DataFrame:
        """Every visible record."""
        last = self.last_append()
        if last < 0:
            return self.spark.createDataFrame([], ENVELOPE)
        files = self.spark.read.schema(DATA_FILES).parquet(self.data_path)
        return to_envelope(files.where(F.col("_append") <= last))

    def records(self, files: Sequence[str]) -> DataFrame:
        """Records of the named data files."""
        if not files:
            return self.spark.createDataFrame([], ENVELOPE)
        reader = self.spark.read.schema(DATA_FILES).option("basePath", self.data_path)
        return to_envelope(reader.parquet(*(f"{self.data_path}/{name}" for name in files)))

    def rows_after(self, starts: DataFrame | Pinned, manifest: DataFrame | None = None) -> DataFrame:
        """Records from each partition's start on, opening only files that hold some.

        By the manifest, a file ends before its partition's start and is not opened,
        lies past it and is read as it is, or holds it. Only the last kind, at most
        one file of a partition, is joined with the starts. The names of the opened
        files pass through the driver, which lists them for the scan in any case.
        ``manifest`` limits the read to its files.
        """
        pinned = starts if isinstance(starts, Pinned) else pin(starts)
        files = self.manifest() if manifest is None else manifest
        unread = files.join(pinned.frame, KEY).where("max_offset >= next_offset")
        named = unread.select("file", (F.col("min_offset") < F.col("next_offset")).alias("cut")).toArrow()
        cut = named.filter(named["cut"])["file"].to_pylist()
        whole = self.records(named.filter(pc.invert(named["cut"]))["file"].to_pylist())
        return whole.unionByName(after_starts(self.records(cut), pinned)) if cut else whole

    def resume(
        self, topics: Sequence[str], starts: DataFrame, *, new_partitions: bool = False
    ) -> DataFrame:
        """Records of ``topics`` from stored ``starts`` on, after checking every one of them.

        A partition without a start is an error, or with ``new_partitions`` read from
        its beginning; so is a start outside the log, or a hole in the offsets past it.
        """
        partitions = pin(discover_topics(self.manifest(), topics)).frame
        if new_partitions:
            starts = add_new_partitions(partitions, starts)
        pinned = pin(starts)
        require_starts(partitions, pinned.frame)
        require_no_gaps(self.manifest(), pinned.frame)
        return self.rows_after(pinned)

    def append(
        self,
        records: DataFrame,
        order: str,
        *,
        rows_per_file: int = ROWS_PER_FILE,
        chunk_bits: int = CHUNK_BITS,
    ) -> int | None:
        """Add ``_key, _message, _topic, _partition`` rows, numbered by ``order``.

        Offsets continue where each partition ends. ``records`` is read more than
        once and has to return the same rows each time, as a table does. Returns
        the number of the append, or None when there were no rows.
        """
        total = records.count()
        if total == 0:
            return None
        number = self.last_append() + 1
        before = self.heads()
        heads = before.select(*KEY, F.col("latest").alias("next_offset"))
        tasks = math.ceil(total / rows_per_file)
        numbered = number_offsets(records, order, heads, tasks, chunk_bits)
        data = f"{self.data_path}/_append={number}"
        (
            to_envelope(numbered)
            .write.mode("overwrite")
            .partitionBy(*KEY)
            .option("maxRecordsPerFile", 2 * rows_per_file)
            .parquet(data)
        )
        staged = self._staged(number, data)
        ends = staged.groupBy(*KEY).agg(F.min("min_offset").alias("low"), (F.max("max_offset") + 1).alias("high"))
        newest = F.when(F.col("high").isNotNull(), F.lit(number)).otherwise(F.col("append")).cast("bigint")
        after = before.join(ends, KEY, "full").select(
            *KEY, F.coalesce("earliest", "low").alias("earliest"), F.coalesce("high", "latest").alias("latest"), newest.alias("append")
        )
        after.write.mode("overwrite").parquet(f"{self.root}/heads/_append={number}")
        previous = before.select(*KEY, F.col("append").alias("previous"))
        manifest = staged.join(previous, KEY, "left").fillna(-1, ["previous"])
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.manifest_path}/_append={number}")
        return number

    def _staged(self, number: int, data: str) -> DataFrame:
        """Rows of the manifest of new data files, written aside: what is visible must come last."""
        written = self.spark.read.schema(DATA_FILES).option("basePath", self.data_path).parquet(data)
        files = written.groupBy(*KEY, F.col("_metadata.file_path").alias("path")).agg(
            F.min("_offset").alias("min_offset"),
            F.max("_offset").alias("max_offset"),
            F.count("*").alias("rows"),
            F.max("_metadata.file_size").alias("bytes"),
        )
        # Paths are decoded once per file, not once per row.
        named = files.select(*KEY, _relative("path").alias("file"), "min_offset", "max_offset", "rows", "bytes")
        fields = [f for f in MANIFEST.fields if f.name not in ("previous", "_append")]
        path = f"{self.root}/staged/_append={number}"
        # By value, so that workers need not have the package.
        cloudpickle.register_pickle_by_value(tidelog)
        try:
            grouped = named.mapInArrow(partial(_with_row_groups, self.data_path), StructType(fields))
        finally:
            cloudpickle.unregister_pickle_by_value(tidelog)
        grouped.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(StructType(fields)).parquet(path)
