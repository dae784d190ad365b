"""What planning reads, which files it names, and how it deals them out; the batch reader and its predicates."""

import random

import pytest
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, In, IsNotNull, LessThan, LessThanOrEqual, StringContains

from tests.conftest import offsets_of, records, write_log
from tidelog.options import ReadOptions
from tidelog.sources import TopicLog, checkpoint_starts, register
from tidelog.sources.files import on_file_system
from tidelog.sources.planning import LogIndex, Range, packed
from tidelog.sources.topiclog import TopicLogReader, TopicLogSource

ROWS = [(i, "hot" if i % 3 else "cold", i % 2 if i % 3 == 0 else 0) for i in range(300)]
ENDS = {"hot": {"0": 200}, "cold": {"0": 50, "1": 50}}


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    return write_log(spark, str(tmp_path_factory.mktemp("log")), ROWS, rows_per_file=40)


def reader(log, **options):
    base = {"path": log.root, "topics": "hot,cold", "group.id": "none", "auto.offset.reset": "smallest"}
    return TopicLogReader(ReadOptions.parse({**base, **options}))


def ranges(tasks):
    return sorted((r.topic, r.partition, r.start, r.end) for task in tasks for r in task.ranges)


def read(source):
    found = {}
    for task in source.partitions():
        for batch in source.read(task):
            for row in batch.to_pylist():
                found.setdefault((row["_topic"], row["_partition"]), []).append(row["_offset"])
    return {key: sorted(offsets) for key, offsets in found.items()}


# --- predicates ---


def test_predicates_reach_planning(log):
    source = reader(log)
    other = StringContains(("_topic",), "o")
    given = [
        IsNotNull(("_topic",)), EqualTo(("_topic",), "hot"), In(("_partition",), (0, 3)), GreaterThanOrEqual(("_offset",), 120),
        LessThan(("_offset",), 130), other, EqualTo(("_key",), b"1"),
    ]
    assert list(source.pushFilters(given)) == [other, given[-1]]
    tasks = source.partitions()
    assert read(source) == {("hot", 0): list(range(120, 130))}
    files = {r.file for task in tasks for r in task.ranges}
    held = {r.file for r in log.manifest().where("_topic = 'hot' AND max_offset >= 120 AND min_offset < 130").collect()}
    assert files == held and len(held) < log.manifest().count()


@pytest.mark.parametrize(
    "given, expected",
    [
        ([GreaterThan(("_offset",), 197)], {("hot", 0): [198, 199]}),
        ([LessThanOrEqual(("_offset",), 1), EqualTo(("_topic",), "cold")], {("cold", 0): [0, 1], ("cold", 1): [0, 1]}),
        ([EqualTo(("_offset",), 7), EqualTo(("_partition",), 1)], {("cold", 1): [7]}),
        ([EqualTo(("_topic",), "gone")], {}),
        ([EqualTo(("_topic",), "hot"), EqualTo(("_topic",), "cold")], {}),
        ([GreaterThan(("_offset",), 9), LessThan(("_offset",), 5)], {}),
    ],
)
def test_predicates_are_exact(log, given, expected):
    source = reader(log)
    assert list(source.pushFilters(given)) == []
    assert read(source) == expected


def test_batch_read(spark, log):
    register(spark)
    frame = spark.read.format("topiclog").option("topics", "hot,cold").option("group.id", "none").load(log.root)
    assert offsets_of(frame) == offsets_of(log.rows())
    few = frame.where("_topic = 'hot' AND _offset >= 190 AND _message IS NOT NULL")
    assert offsets_of(few) == {("hot", 0): list(range(190, 200))}
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert plan.count("_offset#") and "GreaterThanOrEqual" not in plan.split("BatchScan")[0]


def test_batch_read_begins_at_the_group_or_where_told(spark, log, root):
    own = write_log(spark, root, ROWS)
    frame = own.partitions().selectExpr("_topic", "_partition", "latest - 3 AS last_offset")
    from tidelog.sources import GroupTable

    GroupTable(spark, own.groups_path).commit("g", "q", 0, frame)
    assert read(reader(own, **{"group.id": "g"})) == {("hot", 0): [198, 199], ("cold", 0): [48, 49], ("cold", 1): [48, 49]}
    given = '{"hot": {"0": 199}, "cold": {"0": 50, "1": 49}}'
    assert read(reader(own, startingOffsets=given)) == {("hot", 0): [199], ("cold", 1): [49]}
    with pytest.raises(ValueError, match="cold/1: partition has no start"):
        reader(own, startingOffsets='{"hot": {"0": 199}, "cold": {"0": 50}}').partitions()
    with pytest.raises(ValueError, match="startingOffsets"):
        reader(own, startingOffsets='{"hot": 3}')


# --- missing ranges ---


def test_missing_range_is_named(spark, root, tmp_path):
    log = TopicLog(spark, root)
    for no in range(3):
        log.append(records(spark, [(10 * no + i, "hot", 0) for i in range(10)]), "id")
    index = LogIndex(root, ["hot"])
    index.refresh()
    assert len(index.tasks({"hot": {"0": 0}}, {"hot": {"0": 30}}, 100, 2**40)) == 1
    # The newest manifest says that the append before it holds nothing below offset 15.
    lost = log.manifest(after=0, upto=1).drop("_append").selectExpr(
        "_topic", "_partition", "file", "15L AS min_offset", "max_offset", "5L AS rows", "bytes", "group_rows", "group_bytes", "previous"
    )
    path = tmp_path / "log" / "manifest" / "_append=1"
    lost.coalesce(1).write.parquet(str(tmp_path / "changed"))
    for old in path.iterdir():
        old.rename(tmp_path / f"old-{old.name}")
    for new in (tmp_path / "changed").iterdir():
        new.rename(path / new.name)
    again = LogIndex(root, ["hot"])
    again.refresh()
    with pytest.raises(ValueError, match="hot/0: offsets 10 to 14 are missing"):
        again.tasks({"hot": {"0": 0}}, {"hot": {"0": 30}}, 100, 2**40)
    assert ranges(again.tasks({"hot": {"0": 16}}, {"hot": {"0": 30}}, 100, 2**40)) == [("hot", 0, 16, 20), ("hot", 0, 20, 30)]


# --- bounded planning ---


def test_a_refresh_reads_one_row_per_partition(spark, root, tmp_path):
    """1,000 appends: rows read do not grow with their number, only with what is unread."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    appends = 1000
    for no in range(appends):
        touched = 0 if no % 2 else 1
        manifest = pa.table({
            "_topic": ["t"], "_partition": pa.array([touched], pa.int32()), "file": [f"f{no}"],
            "min_offset": [5 * (no // 2)], "max_offset": [5 * (no // 2) + 4], "rows": [5], "bytes": [100],
            "group_rows": pa.array([[5]], pa.list_(pa.int64())), "group_bytes": pa.array([[100]], pa.list_(pa.int64())),
            "previous": [no - 2 if no >= 2 else -1],
        })
        heads = pa.table({
            "_topic": ["t", "t"], "_partition": pa.array([0, 1], pa.int32()), "earliest": [0, 0],
            "latest": [5 * ((no + 1) // 2), 5 * (no // 2 + 1)], "append": [no if no % 2 else no - 1, no - 1 if no % 2 else no],
        })
        for kind, table in (("manifest", manifest), ("heads", heads)):
            folder = tmp_path / "log" / kind / f"_append={no}"
            folder.mkdir(parents=True)
            pq.write_table(table, folder / "part-0.parquet")
    index = LogIndex(root, ["t"])
    index.refresh()
    assert index.rows_read == 2 and index.latest == {"t": {"0": 2500, "1": 2500}}
    index.refresh()
    assert index.rows_read == 2
    near = {"t": {"0": 2488, "1": 2499}}
    assert ranges(index.tasks(near, index.latest, 1000, 2**40)) == [
        ("t", 0, 2488, 2490), ("t", 0, 2490, 2495), ("t", 0, 2495, 2500), ("t", 1, 2499, 2500)
    ]
    assert index.rows_read == 2 + 4 and len(index.appends) == 4
    assert len(ranges(index.tasks({"t": {"0": 0, "1": 2500}}, index.latest, 1000, 2**40))) == 500


def test_positions_come_from_heads(spark, root):
    log = TopicLog(spark, root)
    for no in range(3):
        log.append(records(spark, [(100 * no + i, "t", i % 2 if no else 0) for i in range(6)]), "id")
    found = sorted(map(tuple, log.partitions().collect()))
    assert found == [("t", 0, 0, 12), ("t", 1, 0, 6)]
    assert sorted((r._partition, r.append) for r in log.heads(0).collect()) == [(0, 0)]
    assert len(log.partitions().inputFiles()) <= 4


# --- tasks ---


def piece(start, end, weight, file="f"):
    return Range("t", 0, start, end, file), weight


def test_small_files_share_a_task():
    tasks = list(packed([piece(0, 5, 10, "a"), piece(5, 10, 10, "b"), piece(10, 12, 85, "c"), piece(12, 13, 10, "d")], 100, 100))
    assert [[r.file for r in t.ranges] for t in tasks] == [["a", "b"], ["c", "d"]]
    assert [[r.file for r in t.ranges] for t in packed([piece(0, 60, 1), piece(60, 120, 1), piece(120, 121, 1)], 100, 100)] == [["f"], ["f"]]


def test_neighbours_become_one_range():
    (task,) = packed([piece(0, 5, 1), piece(5, 9, 1)], 100, 100)
    assert task.ranges == [Range("t", 0, 0, 9, "f")]


def test_random_pieces_are_dealt_within_bounds():
    rng = random.Random(5)
    for _ in range(50):
        at, pieces = 0, []
        for no in range(rng.randrange(1, 40)):
            length = rng.randrange(1, 30)
            pieces.append(piece(at, at + length, rng.uniform(0, 50), f"f{no // 3}"))
            at += length
        tasks = list(packed(pieces, 40, 60))
        flat = [r for t in tasks for r in t.ranges]
        assert flat[0].start == 0 and flat[-1].end == at and all(a.end == b.start for a, b in zip(flat, flat[1:]))
        assert all(sum(r.end - r.start for r in t.ranges) <= 40 for t in tasks)


def test_row_groups_split_a_large_file(spark, root):
    spark.conf.set("parquet.block.size", "2048")
    try:
        spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", "2048")
        log = write_log(spark, root, [(i, "hot", 0) for i in range(20_000)], chunk_bits=20)
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
        spark.conf.unset("parquet.block.size")
    row = log.manifest().first()
    assert sum(row.group_rows) == row.rows and row.bytes > 0
    tasks = reader(log, topics="hot", bytesPerTask="4000").partitions()
    assert ranges(tasks)[0][2] == 0 and ranges(tasks)[-1][3] == 20_000
    if len(row.group_rows) > 1:
        edges = {sum(row.group_rows[:k]) for k in range(len(row.group_rows) + 1)}
        assert len(tasks) > 1 and all(r.start in edges for t in tasks for r in t.ranges)


# --- checkpoints and places ---


def test_starts_of_a_checkpoint(spark, log, tmp_path):
    for folder, names in {"offsets": ["0", "1", "2", "3"], "commits": ["0", "1", "2"]}.items():
        (tmp_path / folder).mkdir()
        for name in names:
            (tmp_path / folder / name).write_text(f'v1\n{{"batchWatermarkMs":0}}\n{{"hot": {{"0": {name}7}}}}\n{{"cold": {{"1": {name}}}}}')
    assert [tuple(r) for r in checkpoint_starts(spark, str(tmp_path)).collect()] == [("hot", 0, 27)]
    assert [tuple(r) for r in checkpoint_starts(spark, str(tmp_path), source=1).collect()] == [("cold", 1, 2)]
    with pytest.raises(ValueError, match="no source 2"):
        checkpoint_starts(spark, str(tmp_path), source=2)
    with pytest.raises(ValueError, match="no committed batch"):
        checkpoint_starts(spark, str(tmp_path / "nothing"))


def test_paths_without_a_scheme():
    assert on_file_system("/log", "file:///") == "/log"
    assert on_file_system("/log", "hdfs://name:8020") == "hdfs://name:8020/log"
    assert on_file_system("s3a://bucket/log", "hdfs://name:8020/") == "s3a://bucket/log"
    with pytest.raises(ValueError, match="scheme"):
        on_file_system("log", "hdfs://name:8020")
    given = TopicLogSource({"path": "/x", "topics": "a", "group.id": "g"})
    assert given.settings.path == "/x" and given.batch_settings.reset == "smallest" and given.settings.reset == "largest"
