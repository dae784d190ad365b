"""Fixing a metadata table at its present content."""

from __future__ import annotations

from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.scratch import scratch

#: Most rows (of about 50 bytes) that are kept in the plan instead of a file.
PIN_ROWS = 100_000


class Pinned(NamedTuple):
    frame: DataFrame
    rows: pa.Table | None  # the content, while it is small

    def lowest(self, column: str) -> int | None:
        if self.rows is not None:
            return pc.min(self.rows[column]).as_py()
        return self.frame.agg(F.min(column)).first()[0]


def pin(frame: DataFrame, rows: int = PIN_ROWS) -> Pinned:
    """Fix a table of one row per topic-partition; more than ``rows`` rows are evaluated twice.

    Everything derived from it then agrees even if the table it came from changes
    meanwhile. Up to ``rows`` rows become part of the plan, more are written to the shared folder. Joins are
    planned alike for both, by Spark from the size in bytes.
    """
    spark = frame.sparkSession
    taken = frame.limit(rows + 1).toArrow()
    if taken.num_rows <= rows:
        return Pinned(spark.createDataFrame(taken, schema=frame.schema), taken)
    path = scratch(spark)
    frame.write.parquet(path)
    return Pinned(spark.read.schema(frame.schema).parquet(path), None)
