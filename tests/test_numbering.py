import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import as_dict, records
from tidelog.operators import number_offsets
from tidelog.schema import KEY, STARTS


def expected(frame):
    window = Window.partitionBy(*KEY).orderBy("id")
    return {(r.id, r._offset) for r in frame.select("id", (F.row_number().over(window) - 1).alias("_offset")).collect()}


def hot_rows():
    rng = random.Random(3)
    ids = rng.sample(range(5_000), 600) + [-7, -(2**40), 2**45 + 1, 2**45 + 2, 2**62]
    return [(i, "hot" if n % 3 else f"t{n % 5}", 0 if n % 3 else n % 2) for n, i in enumerate(ids)]


@pytest.mark.parametrize("bits", [1, 4, 21])
def test_equals_row_number(spark, bits):
    frame = records(spark, hot_rows())
    heads = spark.createDataFrame([], STARTS)
    numbered = number_offsets(frame, "id", heads, 5, bits)
    assert {(r.id, r._offset) for r in numbered.collect()} == expected(frame)


def test_continues_at_heads(spark):
    frame = records(spark, [(i, "a", i % 2) for i in range(20)])
    heads = spark.createDataFrame([("a", 1, 100)], STARTS)
    numbered = number_offsets(frame, "id", heads, 2, 2)
    lows = as_dict(numbered.groupBy(*KEY).agg(F.min("_offset").alias("low")), "low")
    assert lows == {("a", 0): 0, ("a", 1): 100}


def test_hot_partition_spreads_in_disjoint_ranges(spark):
    frame = records(spark, [(i, "hot", 0) for i in range(4_000)])
    numbered = number_offsets(frame, "id", spark.createDataFrame([], STARTS), 8, 4)
    spans = (
        numbered.groupBy(F.spark_partition_id().alias("task"))
        .agg(F.min("_offset").alias("low"), F.max("_offset").alias("high"), F.count("*").alias("n"))
        .orderBy("low")
        .collect()
    )
    assert len(spans) >= 6
    assert all(left.high < right.low for left, right in zip(spans, spans[1:]))
    assert all(span.high - span.low + 1 == span.n for span in spans)
