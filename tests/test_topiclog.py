"""The offset-exact streaming source, alone and under Structured Streaming."""

import json
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import as_dict, offsets_of, records, write_log
from tidelog.options import ReadOptions
from tidelog.schema import ENVELOPE
from tidelog.sources import GroupTable, register
from tidelog.sources.topiclog import TopicLogSource, TopicLogStreamReader

ROWS = [(i, "hot" if i % 3 else "cold", i % 2 if i % 3 == 0 else 0) for i in range(300)]
ENDS = {"hot": {"0": 200}, "cold": {"0": 50, "1": 50}}
ZERO = {"hot": {"0": 0}, "cold": {"0": 0, "1": 0}}
OFFSETS = "_topic string, _partition int, last_offset bigint"


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    return write_log(spark, str(tmp_path_factory.mktemp("log")), ROWS, rows_per_file=40)


def reader(log, **options):
    base = {"path": log.root, "topics": "hot,cold", "group.id": "g", "auto.offset.reset": "smallest"}
    return TopicLogStreamReader(ReadOptions.parse({**base, **options}))


def read(source, start, end):
    found = {}
    for task in source.partitions(start, end):
        for batch in source.read(task):
            for row in batch.to_pylist():
                found.setdefault((row["_topic"], row["_partition"]), []).append(row["_offset"])
    return found


# --- planning ---


def test_offsets(log):
    assert reader(log).latestOffset() == ENDS
    assert reader(log).initialOffset() == ZERO
    assert reader(log, **{"auto.offset.reset": "largest"}).initialOffset() == ENDS
    json.dumps(ENDS)


def test_group_positions_all_or_nothing(spark, root):
    log = write_log(spark, root, ROWS)
    groups = GroupTable(spark, log.groups_path)
    half = spark.createDataFrame([("hot", 0, 99), ("cold", 0, 9)], OFFSETS)
    groups.commit("g", "q", 0, half)
    assert reader(log).initialOffset() == ZERO
    assert reader(log, topics="hot").initialOffset() == {"hot": {"0": 100}}
    groups.commit("g", "q", 1, spark.createDataFrame([("cold", 1, -1)], OFFSETS))
    assert reader(log).initialOffset() == {"hot": {"0": 100}, "cold": {"0": 10, "1": 0}}


def test_unknown_topic(log):
    with pytest.raises(ValueError, match="gone"):
        reader(log, topics="hot,gone").latestOffset()


def test_tasks_split_a_hot_partition(log):
    tasks = reader(log, rowsPerTask="16").partitions({**ZERO, "hot": {"0": 5}}, ENDS)
    assert all(sum(part.end - part.start for part in task.ranges) <= 16 for task in tasks)
    hot = sorted((part.start, part.end) for task in tasks for part in task.ranges if part.topic == "hot")
    assert hot[0][0] == 5 and hot[-1][1] == 200 and len(hot) > 10
    assert all(left[1] == right[0] for left, right in zip(hot, hot[1:]))


def test_nothing_new_means_no_task(log):
    assert reader(log).partitions(ENDS, ENDS) == []


@pytest.mark.parametrize(
    "start, end, problem",
    [
        ({"hot": {"0": 0}, "cold": {"0": 0}}, ENDS, "cold/1: partition has no start"),
        ({**ZERO, "hot": {"0": 0, "1": 0}}, ENDS, "hot/1: partition is gone"),
        ({**ZERO, "hot": {"0": 201}}, ENDS, "hot/0: start offset lies beyond"),
        (ENDS, {**ENDS, "hot": {"0": 199}}, "hot/0: start offset lies beyond"),
        ({**ZERO, "hot": {"0": -1}}, ENDS, "hot/0: records before"),
    ],
)
def test_unreadable_ranges(log, start, end, problem):
    with pytest.raises(ValueError, match=problem):
        reader(log).partitions(start, end)


def test_new_partition_from_its_beginning(log):
    source = reader(log, onNewPartition="earliest")
    found = read(source, {"hot": {"0": 200}, "cold": {"0": 50}}, ENDS)
    assert found == {("cold", 1): list(range(50))}


def test_schema_is_fixed(log):
    source = TopicLogSource({"path": log.root, "topics": "hot", "group.id": "g"})
    assert source.schema() == ENVELOPE
    source.streamReader(ENVELOPE)
    from pyspark.sql.types import StructType

    with pytest.raises(ValueError, match="fixed"):
        source.streamReader(StructType.fromDDL("x int"))


# --- reading ---


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.data())
def test_batches_concatenate_to_one_scan(log, data):
    """Random starts, batch cuts and idle partitions lose and repeat nothing."""
    cuts = data.draw(st.integers(1, 4))
    ladder = {
        (topic, p): sorted(data.draw(st.lists(st.integers(0, end), min_size=cuts + 1, max_size=cuts + 1)))
        for topic, parts in ENDS.items()
        for p, end in parts.items()
    }
    source = reader(log, rowsPerTask=str(data.draw(st.integers(1, 60))))

    def position(step):
        offsets = {}
        for (topic, p), steps in ladder.items():
            offsets.setdefault(topic, {})[p] = steps[step]
        return offsets

    found = {}
    for step in range(cuts):
        for key, offsets in read(source, position(step), position(step + 1)).items():
            found.setdefault(key, []).extend(sorted(offsets))
    expected = {
        (topic, int(p)): list(range(steps[0], steps[-1]))
        for (topic, p), steps in ladder.items()
        if steps[0] < steps[-1]
    }
    assert found == expected


def test_consumed_files_can_be_planned_again(log):
    source = reader(log)
    assert read(source, {**ENDS, "hot": {"0": 190}}, ENDS) == {("hot", 0): list(range(190, 200))}
    assert sum(map(len, read(source, ZERO, ENDS).values())) == 300


# --- commits by the source ---


def test_commit_stores_last_offsets_once(spark, root):
    log = write_log(spark, root, ROWS)
    source = reader(log)
    source.commit({"hot": {"0": 10}, "cold": {"0": 0, "1": 4}})
    source.commit({"hot": {"0": 10}, "cold": {"0": 0, "1": 4}})
    reader(log).commit({"hot": {"0": 10}, "cold": {"0": 0, "1": 4}})  # after a restart
    groups = GroupTable(spark, log.groups_path)
    assert groups.commits("g").count() == 3
    assert as_dict(groups.latest("g"), "last_offset") == {("hot", 0): 9, ("cold", 0): -1, ("cold", 1): 3}
    assert reader(log).initialOffset() == {"hot": {"0": 10}, "cold": {"0": 0, "1": 4}}
    reader(log, commit="false").commit(ENDS)
    assert groups.commits("g").count() == 3


@pytest.mark.parametrize("group", ["123", "my group+%20", "a/b=c:d", "ü{x}[y]'\"#?*^\\"])
def test_group_names_mean_the_same_to_spark(spark, root, group):
    log = write_log(spark, root, ROWS)
    groups = GroupTable(spark, log.groups_path)
    at = {"hot": {"0": 10}, "cold": {"0": 1, "1": 4}}
    ends = log.partitions().selectExpr("_topic", "_partition", "latest - 1 AS last_offset")
    reader(log, **{"group.id": group}).commit(at)
    assert as_dict(groups.latest(group), "last_offset")["hot", 0] == 9
    assert reader(log, **{"group.id": group}).initialOffset() == at
    groups.commit(group, "q", 0, ends)
    assert reader(log, **{"group.id": group}).initialOffset() == ENDS


def test_failed_commit_raises(spark, root):
    log = write_log(spark, root, ROWS)
    Path(log.groups_path).write_text("not a folder")
    with pytest.raises(Exception):
        reader(log).commit(ENDS)


# --- under Structured Streaming ---


def stream(log, **options):
    register(log.spark)
    frame = log.spark.readStream.format("topiclog").option("topics", "hot,cold").option("group.id", "g")
    for key, value in {"auto.offset.reset": "smallest", **options}.items():
        frame = frame.option(key, value)
    return frame.load(log.root)


def drain(frame, out, checkpoint="checkpoint"):
    query = (
        frame.writeStream.format("parquet")
        .option("checkpointLocation", str(out / checkpoint))
        .trigger(availableNow=True)
        .start(str(out / "rows"))
    )
    query.awaitTermination()


def written(spark, out):
    return offsets_of(spark.read.parquet(str(out / "rows")))


def test_stream_schema(log):
    assert stream(log).schema == ENVELOPE


def test_processing_time_trigger(spark, log, tmp_path):
    out = str(tmp_path / "rows")
    query = (
        stream(log, rowsPerTask="30")
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(processingTime="1 second")
        .start(out)
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert offsets_of(spark.read.parquet(out)) == offsets_of(log.rows())


def test_continuous_trigger_is_refused(log, tmp_path):
    writer = stream(log).writeStream.format("noop").option("checkpointLocation", str(tmp_path))
    with pytest.raises(Exception, match="continuous"):
        writer.trigger(continuous="1 second").start().awaitTermination(60)


def test_missing_option_fails_at_load(spark, log):
    register(spark)
    with pytest.raises(Exception, match="group.id"):
        spark.readStream.format("topiclog").option("topics", "hot").load(log.root)


def test_user_schema_is_refused(spark, log):
    register(spark)
    frame = (
        spark.readStream.format("topiclog").schema("x int").option("topics", "hot").option("group.id", "g")
    )
    with pytest.raises(Exception, match="(?s)fixed"):
        query = frame.load(log.root).writeStream.format("noop").trigger(availableNow=True).start()
        query.awaitTermination()


def test_largest_returns_all_and_only_later_records(spark, root, tmp_path):
    log = write_log(spark, root, ROWS)
    out = tmp_path / "out"
    # The start is resolved with the first batch; the records come after it.
    drain(stream(log, **{"auto.offset.reset": "largest"}), out)
    log.append(records(spark, [(1000 + i, "hot", 0) for i in range(7)]), "id", chunk_bits=2)
    drain(stream(log, **{"auto.offset.reset": "largest"}), out)
    assert written(spark, out) == {("hot", 0): list(range(200, 207))}


def test_checkpoint_outranks_the_group(spark, root, tmp_path):
    log = write_log(spark, root, ROWS)
    drain(stream(log), tmp_path)
    rewound = log.partitions().selectExpr("_topic", "_partition", "cast(0 AS bigint) AS last_offset")
    GroupTable(spark, log.groups_path).commit("g", "other", 0, rewound)
    log.append(records(spark, [(1000 + i, "hot", 0) for i in range(3)]), "id", chunk_bits=2)
    drain(stream(log), tmp_path)
    assert written(spark, tmp_path) == {
        ("hot", 0): list(range(203)),
        ("cold", 0): list(range(50)),
        ("cold", 1): list(range(50)),
    }


def test_group_continues_without_the_checkpoint(spark, root, tmp_path):
    log = write_log(spark, root, ROWS)
    first, second = tmp_path / "first", tmp_path / "second"
    drain(stream(log), first)
    log.append(records(spark, [(1000 + i, "hot", 0) for i in range(5)]), "id", chunk_bits=2)
    drain(stream(log), first)  # planning this batch commits the one before
    assert sum(map(len, written(spark, first).values())) == 305
    group = as_dict(GroupTable(spark, log.groups_path).latest("g"), "last_offset")
    assert group == {("hot", 0): 199, ("cold", 0): 49, ("cold", 1): 49}
    drain(stream(log, **{"auto.offset.reset": "largest"}), second)
    assert written(spark, second) == {("hot", 0): list(range(200, 205))}


def test_a_batch_past_the_end_is_empty(spark, log):
    register(spark)
    source = spark.read.format("topiclog").option("topics", "hot,cold").option("group.id", "past")
    assert source.load(log.root).where("_offset >= 100000").collect() == []
