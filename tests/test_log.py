"""Log files, manifest and scans."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import as_dict, offsets_of, records, write_log
from tidelog.operators import add_new_partitions, after_starts, discover_topics, offset_range, pin, subscribe
from tidelog.schema import ENVELOPE, KEY, STARTS
from tidelog.sources import TopicLog

ROWS = [(i, "hot" if i % 3 else "cold", i % 2 if i % 3 == 0 else 0) for i in range(300)]


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    return write_log(spark, str(tmp_path_factory.mktemp("log")), ROWS, rows_per_file=40)


def starts(spark, *rows):
    return spark.createDataFrame(list(rows), STARTS)


def test_empty_log(spark, root):
    log = TopicLog(spark, root)
    assert log.last_append() == -1
    assert log.rows().isEmpty() and log.manifest().isEmpty()
    assert log.append(records(spark, []), "id") is None


def test_rows_are_numbered_and_kept(log):
    assert [(f.name, f.dataType) for f in log.rows().schema] == [(f.name, f.dataType) for f in ENVELOPE]
    assert offsets_of(log.rows()) == {
        ("hot", 0): list(range(200)),
        ("cold", 0): list(range(50)),
        ("cold", 1): list(range(50)),
    }
    row = log.rows().where("_topic = 'hot' AND _offset = 1").first()
    assert (bytes(row._key), bytes(row._message)) == (b"2", b"m2")


def test_manifest_describes_disjoint_sorted_files(spark, log):
    manifest = sorted(log.manifest().collect(), key=lambda r: (r._topic, r._partition, r.min_offset))
    assert sum(r._topic == "hot" for r in manifest) >= 3  # the hot partition is split
    for row in manifest:
        stored = spark.read.parquet(f"{log.data_path}/{row.file}").select("_offset").collect()
        assert [r._offset for r in stored] == list(range(row.min_offset, row.max_offset + 1))
        assert row.rows == row.max_offset - row.min_offset + 1
    for left, right in zip(manifest, manifest[1:]):
        if (left._topic, left._partition) == (right._topic, right._partition):
            assert left.max_offset < right.min_offset


def test_append_continues_offsets(spark, root):
    log = write_log(spark, root, [(i, "a", 0) for i in range(10)])
    assert log.append(records(spark, [(i, "a", i % 2) for i in range(10, 20)]), "id", chunk_bits=1) == 1
    assert offsets_of(log.rows()) == {("a", 0): list(range(15)), ("a", 1): list(range(5))}
    payload = log.rows().where("_partition = 0 AND _offset = 10").first()
    assert bytes(payload._key) == b"10"


def test_unfinished_append_is_invisible_and_replaced(spark, root):
    log = write_log(spark, root, [(i, "a", 0) for i in range(10)])
    log.rows().limit(4).write.partitionBy(*KEY).parquet(f"{log.data_path}/_append=1")
    assert log.last_append() == 0
    assert log.rows().count() == 10
    assert log.append(records(spark, [(10, "a", 0)]), "id") == 1
    assert offsets_of(log.rows()) == {("a", 0): list(range(11))}


def test_special_characters_in_topics(spark, root):
    topics = ["a+b", "a b%20", "ü:=/x"]
    log = write_log(spark, root, [(i, topics[i % 3], 0) for i in range(9)])
    assert offsets_of(log.rows()) == {(topic, 0): [0, 1, 2] for topic in topics}
    found = log.rows_after(starts(spark, *((topic, 0, 1) for topic in topics)))
    assert offsets_of(found) == {(topic, 0): [1, 2] for topic in topics}


def test_discovery(log):
    found = discover_topics(log.manifest(), ["hot"]).collect()
    assert [(r._topic, r._partition, r.earliest, r.latest) for r in found] == [("hot", 0, 0, 200)]
    with pytest.raises(ValueError, match="gone"):
        discover_topics(log.manifest(), ["hot", "gone"])


def test_scan_is_exact_and_opens_only_needed_files(spark, log):
    begin = starts(spark, ("hot", 0, 150), ("cold", 1, 49))
    found = log.rows_after(begin)
    assert offsets_of(found) == {("hot", 0): list(range(150, 200)), ("cold", 1): [49]}
    assert len(found.inputFiles()) < len(log.rows().inputFiles()) / 2


def test_scan_joins_only_the_files_that_hold_a_start(spark, log):
    begin = starts(spark, ("hot", 0, 150), ("cold", 1, 0))
    for pinned in (pin(begin), pin(begin, rows=1)):
        found = log.rows_after(pinned)
        assert offsets_of(found) == {("hot", 0): list(range(150, 200)), ("cold", 1): list(range(50))}
        assert len(found.inputFiles()) < len(log.rows().inputFiles())
    at_file = log.manifest().where("_topic = 'hot'").agg({"min_offset": "max"}).first()[0]
    whole = log.rows_after(starts(spark, ("hot", 0, at_file), ("cold", 1, 0)))
    assert "Join" not in whole._jdf.queryExecution().optimizedPlan().toString()


def test_scan_at_the_end_is_empty(spark, log):
    assert log.rows_after(starts(spark, ("hot", 0, 200))).isEmpty()


@pytest.mark.parametrize("new_partitions", [False, True])
def test_pinned_in_the_plan_or_in_a_file(spark, log, new_partitions):
    begin = starts(spark, ("hot", 0, 120), ("cold", 0, 10))
    kept, written = pin(begin), pin(begin, rows=1)
    assert kept.rows is not None and written.rows is None
    found = [offsets_of(after_starts(log.rows(), pinned, new_partitions=new_partitions)) for pinned in (kept, written)]
    assert found[0] == found[1] and (("cold", 1) in found[0]) is new_partitions


def test_same_plan_for_few_and_many_starts(spark, log):
    """Operators of a scan after 10 and after 200,000 starts."""

    def operators(count):
        rows = spark.range(count).selectExpr("concat('t', id) AS _topic", "cast(id % 7 AS int) AS _partition", "id AS next_offset")
        frame = after_starts(log.rows(), pin(rows.unionByName(starts(spark, ("hot", 0, 5)))))
        assert offsets_of(frame) == {("hot", 0): list(range(5, 200))}
        plan = frame._jdf.queryExecution().executedPlan().toString()
        return [name for name in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "Exchange hash") if name in plan]

    assert operators(10) == operators(200_000) == ["BroadcastHashJoin"]


def test_offset_range_is_half_open(log):
    assert offsets_of(offset_range(log.rows(), "hot", 0, 5, 9)) == {("hot", 0): [5, 6, 7, 8]}
    assert offsets_of(offset_range(log.rows(), "cold", 1, 48)) == {("cold", 1): [48, 49]}


def test_filters_reach_the_scan(log):
    plan = offset_range(log.rows(), "hot", 0, 5, 9)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(_offset,5)" in plan and "LessThan(_offset,9)" in plan
    assert "_topic#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    keys = subscribe(log.rows(), ["cold"]).select("_key")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<_key:binary>" in keys


def test_resume_checks_every_start(spark, log):
    good = starts(spark, ("hot", 0, 150), ("cold", 0, 50), ("cold", 1, 49))
    assert offsets_of(log.resume(["hot", "cold"], good)) == {
        ("hot", 0): list(range(150, 200)),
        ("cold", 1): [49],
    }
    partial = starts(spark, ("hot", 0, 150), ("cold", 0, 50))
    with pytest.raises(ValueError, match="cold/1: partition has no start"):
        log.resume(["hot", "cold"], partial)
    assert offsets_of(log.resume(["hot", "cold"], partial, new_partitions=True)) == {
        ("hot", 0): list(range(150, 200)),
        ("cold", 1): list(range(50)),
    }
    for rows, problem in [
        ([("hot", 0, 201)], "beyond the end"),
        ([("hot", 0, 5), ("hot", 9, 5)], "hot/9: .* does not exist"),
    ]:
        for new_partitions in (False, True):
            with pytest.raises(ValueError, match=problem):
                log.resume(["hot"], starts(spark, *rows), new_partitions=new_partitions)


def test_batches_with_new_partitions(spark, log):
    begin = add_new_partitions(log.partitions(), starts(spark, ("hot", 0, 199)))
    assert as_dict(begin, "next_offset") == {("hot", 0): 199, ("cold", 0): 0, ("cold", 1): 0}
    assert log.rows_after(begin).agg(F.count("*").alias("n")).first().n == 101
