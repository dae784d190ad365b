"""Starts, progress, offset JSON and task ranges."""

import json

import pytest

from tests.conftest import as_dict
from tidelog.functions import decode_offsets, encode_offsets, encode_topics
from tidelog.operators import (
    add_new_partitions,
    compare_offsets,
    discover,
    merge_offsets,
    offsets_equal,
    require_starts,
    resolve_starts,
    start_problems,
    starts_after,
)
from tidelog.schema import STARTS

PARTS = "_topic string, _partition int, earliest bigint, latest bigint"
OFFSETS = "_topic string, _partition int, last_offset bigint"


@pytest.fixture
def parts(spark):
    return spark.createDataFrame([("a", 0, 5, 10), ("a", 1, 0, 4)], PARTS)


def offsets(spark, *rows):
    return spark.createDataFrame(list(rows), OFFSETS)


def starts(spark, *rows):
    return spark.createDataFrame(list(rows), STARTS)


def test_covered_group_resumes_after_last(spark, parts):
    committed = offsets(spark, ("a", 0, 7), ("a", 1, 3), ("other", 0, 9))
    assert as_dict(resolve_starts(parts, committed, "smallest"), "next_offset") == {("a", 0): 8, ("a", 1): 4}


@pytest.mark.parametrize("reset, expected", [("smallest", (5, 0)), ("largest", (10, 4))])
@pytest.mark.parametrize("committed", [[], [("a", 0, 7)]])
def test_gap_sends_all_partitions_to_reset(spark, parts, committed, reset, expected):
    found = as_dict(resolve_starts(parts, offsets(spark, *committed), reset), "next_offset")
    assert (found["a", 0], found["a", 1]) == expected


def test_unknown_reset(spark, parts):
    with pytest.raises(ValueError):
        resolve_starts(parts, offsets(spark), "middle")


@pytest.mark.parametrize(
    "rows, problem",
    [
        ([("a", 0, 8)], "a/1: partition has no start"),
        ([("a", 0, 8), ("a", 1, 0), ("b", 0, 0)], "b/0: .* does not exist"),
        ([("a", 0, 4), ("a", 1, 0)], "a/0: records before the earliest"),
        ([("a", 0, 8), ("a", 1, 5)], "a/1: start offset lies beyond"),
    ],
)
def test_unreadable_starts(spark, parts, rows, problem):
    with pytest.raises(ValueError, match=problem):
        require_starts(parts, starts(spark, *rows))


def test_readable_starts(spark, parts):
    good = starts(spark, ("a", 0, 10), ("a", 1, 0))
    require_starts(parts, good)
    assert start_problems(parts, good).isEmpty()


def test_new_partitions_begin_at_earliest(spark, parts):
    found = as_dict(add_new_partitions(parts, starts(spark, ("a", 1, 2))), "next_offset")
    assert found == {("a", 0): 5, ("a", 1): 2}


def test_merge_keeps_idle_partitions(spark):
    began = starts(spark, ("a", 0, 8), ("a", 1, 4), ("a", 2, 0))
    merged = merge_offsets(began, offsets(spark, ("a", 1, 9)))
    assert as_dict(merged, "last_offset") == {("a", 0): 7, ("a", 1): 9, ("a", 2): -1}


def test_discover(spark):
    rows = spark.createDataFrame([("a", 0, 3), ("a", 0, 5), ("b", 1, 0)], "_topic string, _partition int, _offset bigint")
    found = {(r._topic, r._partition): (r.earliest, r.latest) for r in discover(rows).collect()}
    assert found == {("a", 0): (3, 6), ("b", 1): (0, 1)}


# --- JSON ---


def test_encode_sorts_numerically(spark):
    frame = offsets(spark, ("b", 10, 1), ("b", 2, 2), ("a", 0, 3))
    assert encode_offsets(frame).first().offsets == '{"a":{"0":3},"b":{"2":2,"10":1}}'
    assert as_topics(frame) == {"a": '{"0":3}', "b": '{"2":2,"10":1}'}


def as_topics(frame):
    return {row._topic: row.offsets for row in encode_topics(frame).collect()}


def test_empty_document(spark):
    assert encode_offsets(offsets(spark)).first().offsets == "{}"
    documents = spark.createDataFrame([("{}",)], "offsets string")
    assert decode_offsets(documents).isEmpty()


def test_roundtrip_and_equality(spark):
    frame = offsets(spark, ("click", 0, 481), ("click", 1, -1), ("a.b-c_d", 3, 2**60))
    again = decode_offsets(encode_offsets(frame))
    assert offsets_equal(frame, again)
    assert starts_after(again).where("next_offset = 482").count() == 1
    assert json.loads(encode_offsets(again).first().offsets)["a.b-c_d"] == {"3": 2**60}


@pytest.mark.parametrize(
    "document",
    ['{"a":oops', '{"a":1}', '{"a":{"x":1}}', '{"a":{"0":"x"}}', '{"a":{"0":null}}', '{"a":null}', "null", "[]"],
)
def test_bad_documents_fail(spark, document):
    frame = spark.createDataFrame([(document,)], "offsets string")
    with pytest.raises(Exception):
        decode_offsets(frame).collect()


def test_compare_counts_differences(spark):
    left = offsets(spark, ("a", 0, 1), ("a", 1, 1))
    right = offsets(spark, ("a", 0, 1), ("a", 2, 1))
    row = compare_offsets(left, right).first()
    assert (row.partitions, row.different, row.equal) == (3, 2, False)
    assert not offsets_equal(left, right)
