"""What the operators of this subpackage share: tables, stored intermediates, Arrow batches and word hashes.

Words of the deduplication operators are runs of characters other than space and ``\\t`` to ``\\r``. On UTF-8 bytes
that is exactly ``bytes.split()``, and ``bytes.lower()`` lowers exactly A-Z, so both run in C on whole texts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.scratch import scratch

#: A hash memo is dropped at this many words, so that a task's memory does not grow with its vocabulary.
MEMO_WORDS = 300_000
#: Tables of up to this many ids (of 8 bytes) are broadcast to the rows that they decide about.
SENT_ROWS = 1_000_000
#: Odd multipliers for hashing a sequence of word hashes; fixed values, so that hashes agree between jobs.
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame) -> DataFrame:
    """The frame, written to the shared folder and read again: it is computed once and survives lost executors."""
    path = scratch(frame.sparkSession)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Removes tables of ``stored`` that no later work reads."""
    for frame in frames:
        spark = frame.sparkSession
        for folder in {name.rsplit("/", 1)[0] for name in frame.inputFiles()}:
            if folder.rsplit("/", 1)[1].startswith("tidelog-"):
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh_name(what: str) -> str:
    """A column name that no table has."""
    return f"_{what}_{uuid.uuid4().hex}"


def sent(ids: DataFrame) -> DataFrame:
    """A written table of ids, marked for broadcast if it has at most ``SENT_ROWS`` rows; a larger one is joined by shuffle."""
    return F.broadcast(ids) if ids.count() <= SENT_ROWS else ids


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def smallest_hashes(frame: DataFrame, column: str, most: int) -> DataFrame:
    """At most ``most`` rows of ``frame``, those with the smallest values of ``column``, a 64-bit hash of distinct keys.

    The range of hashes is cut to about one and a half times as many rows first, so that no task gathers more than these,
    whatever the number of partitions.
    """
    share = min(1.0, 1.5 * most / max(1, frame.count()))
    return frame.where(F.col(column) <= int(share * (2**64 - 1)) - 2**63 if share < 1 else F.lit(True)).orderBy(column).limit(most)


def small_batches(batches: Iterable[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``most`` bytes in a text column; one text is never cut."""
    for batch in batches:
        sizes = batch.column(column).fill_null("") if batch.num_rows else None
        if sizes is None:
            continue
        ends = np.cumsum([len(x) for x in sizes.cast(pa.binary()).to_pylist()]) if batch.nbytes > most else None
        if ends is None:
            yield batch
            continue
        begin = 0
        while begin < batch.num_rows:
            floor = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, floor + most, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end
    # Workers outlive their task; what Arrow keeps for later would count against the next one's memory.
    pa.default_memory_pool().release_unused()


def raw_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


class WordHashes(dict):
    """Word (bytes) to 64-bit hash, remembered for the words seen lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all output bits."""
    values = values ^ (values >> np.uint64(30))
    values = values * MIX[0]
    values = values ^ (values >> np.uint64(27))
    values = values * MIX[1]
    return values ^ (values >> np.uint64(31))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` consecutive words, in order."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for k in range(size):
        out = out * BASE + words[k : k + count]
    return mixed(out)


def signed(values: np.ndarray) -> np.ndarray:
    """Unsigned hashes as Spark's long."""
    return values.view(np.int64)
