"""Committed positions."""

from datetime import datetime

import pytest

from tests.conftest import as_dict, write_log
from tidelog.schema import STARTS
from tidelog.sources import GroupTable

OFFSETS = "_topic string, _partition int, last_offset bigint"


@pytest.fixture
def groups(spark, tmp_path):
    return GroupTable(spark, str(tmp_path / "groups"))


def at(*rows):
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession().createDataFrame(list(rows), OFFSETS)


def test_no_commits(groups):
    assert groups.latest("g").isEmpty()


def test_newest_commit_wins_over_largest(groups):
    groups.commit("g", "q1", 7, at(("a", 0, 90)), datetime(2024, 1, 1))
    groups.commit("g", "q2", 0, at(("a", 0, 10)), datetime(2024, 1, 2))
    assert as_dict(groups.latest("g"), "last_offset") == {("a", 0): 10}


def test_unchanged_position_is_not_written_again(groups):
    assert groups.commit("g", "q", 0, at(("a", 0, 5), ("a", 1, -1)))
    assert not groups.commit("g", "q", 1, at(("a", 0, 5), ("a", 1, -1)))
    assert groups.commits().select("batch_id").distinct().count() == 1
    assert groups.commit("g", "q", 2, at(("a", 0, 6), ("a", 1, -1)))


def test_replay_overwrites_its_batch_only(groups):
    groups.commit("g", "q", 0, at(("a", 0, 5)))
    groups.commit("g", "q", 1, at(("a", 0, 8)))
    groups.commit("g", "q", 1, at(("a", 0, 9)))
    groups.commit("h", "q", 1, at(("a", 0, 1)))
    found = sorted((r.group_id, r.batch_id, r.last_offset) for r in groups.commits().collect())
    assert found == [("g", 0, 5), ("g", 1, 9), ("h", 1, 1)]


@pytest.mark.parametrize("name", ["123", "a/b=c", "ü %41 +"])
def test_group_names_survive_the_path(groups, name):
    groups.commit(name, "q", 0, at(("a", 0, 5)))
    assert groups.latest(name).first().group_id == name


def test_failing_commit_raises(groups, tmp_path):
    (tmp_path / "groups").write_text("not a folder")
    with pytest.raises(Exception):
        groups.commit("g", "q", 0, at(("a", 0, 5)))


def test_commit_read(spark, groups, root):
    log = write_log(spark, root, [(i, "a", i % 2) for i in range(10)])
    starts = spark.createDataFrame([("a", 0, 2), ("a", 1, 3)], STARTS)
    groups.commit_read("g", "q", 0, starts, log.rows_after(starts).where("_partition = 0"))
    assert as_dict(groups.latest("g"), "last_offset") == {("a", 0): 4, ("a", 1): 2}
