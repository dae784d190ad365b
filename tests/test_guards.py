"""Inputs that must fail rather than lose records."""

import pytest
from tests.conftest import records, write_log

from tidelog.functions.payload import json_field
from tidelog.operators.starts import offset_gaps, require_no_gaps
from tidelog.options import ReadOptions
from tidelog.sources import TopicLog
from tidelog.streaming import start_committing

STARTS = "_topic string, _partition int, next_offset bigint"
OPTIONS = {"path": "/log", "topics": "a", "group.id": "g"}


@pytest.mark.parametrize("row", [(None, "a", 0), (1, None, 0), (1, "a", None)])
def test_nulls_are_not_appended(spark, root, row):
    with pytest.raises(Exception, match="is null in records to append"):
        TopicLog(spark, root).append(records(spark, [(5, "a", 0), row]), "id")


def test_repeated_order_is_not_appended(spark, root):
    with pytest.raises(Exception, match="column 'id' repeats: 5"):
        TopicLog(spark, root).append(records(spark, [(5, "a", 0), (5, "a", 0)]), "id")


def test_gaps_are_found(spark):
    manifest = spark.createDataFrame(
        [("a", 0, "f1", 0, 9, 10), ("a", 0, "f2", 100, 109, 10), ("a", 1, "f3", 3, 7, 4)],
        "_topic string, _partition int, file string, min_offset bigint, max_offset bigint, rows bigint",
    )
    starts = spark.createDataFrame([("a", 0, 5), ("a", 1, 3)], STARTS)
    assert sorted(map(tuple, offset_gaps(manifest, starts).collect())) == [("a", 0, 10, 99), ("a", 1, 3, 7)]
    with pytest.raises(ValueError, match="a/0: offsets 10 to 99 are missing"):
        require_no_gaps(manifest, starts)
    whole = spark.createDataFrame([("a", 0, 100)], STARTS)
    require_no_gaps(manifest, whole)


def test_stream_fails_on_a_partition_without_start(spark, root, tmp_path):
    log = write_log(spark, root, [(1, "a", 0), (2, "a", 1)])
    starts = spark.createDataFrame([("a", 0, 0)], STARTS)
    query = start_committing(
        log, ["a"], starts, lambda batch, batch_id: batch.collect(),
        group_id="g", checkpoint=str(tmp_path / "cp"), trigger={"availableNow": True},
    )
    with pytest.raises(Exception, match="partition has no start offset: a/1"):
        query.awaitTermination()


def test_commit_option_has_an_older_name():
    assert ReadOptions.parse({**OPTIONS, "auto.commit.enable": "false"}).commit is False
    assert ReadOptions.parse(OPTIONS).commit is True
    with pytest.raises(ValueError, match="contradict"):
        ReadOptions.parse({**OPTIONS, "auto.commit.enable": "false", "commit": "true"})


def test_payload_that_does_not_fit(spark):
    frame = spark.createDataFrame([(bytearray(b'{"k":"abc"}'),), (bytearray(b'{"k":7}'),)], "_message binary")
    assert [r[0] for r in frame.select(json_field("$.k", "int")).collect()] == [None, 7]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        frame.select(json_field("$.k", "int", strict=True)).collect()
