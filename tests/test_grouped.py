"""Runs of offsets, and group positions of streams without a manifest."""

import random
from datetime import datetime, timedelta

import pytest

from tests.conftest import as_dict, records, write_log
from tidelog.operators.runs import consumed_before, holes, merge_runs, offset_runs, reached
from tidelog.schema import ENVELOPE, RUNS, STARTS
from tidelog.sources import GroupTable
from tidelog.sources.group_log import GroupLog, Marker, decisive, parse_markers
from tidelog.sources.topiclog import TopicLogStreamReader
from tidelog.streaming import start_grouped
from tidelog.streaming.grouped import advance

OFFSETS = "_topic string, _partition int, last_offset bigint"


def envelopes(spark, offsets, topic="t", partition=0):
    return spark.createDataFrame([(None, b"m", topic, partition, o) for o in offsets], ENVELOPE)


def found(runs):
    return sorted((r["first"], r["last"]) for r in runs.collect())


def expected_runs(offsets):
    out = []
    for o in sorted(set(offsets)):
        if out and out[-1][1] == o - 1:
            out[-1] = (out[-1][0], o)
        else:
            out.append((o, o))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_runs_of_random_offsets(spark, seed):
    rng = random.Random(seed)
    offsets = [o for low in rng.sample(range(0, 300_000, 500), 8) for o in range(low, low + rng.choice([1, 64, 700]))]
    offsets += offsets[:50] + [63, 64, 65_535, 65_536, 2**40]
    rng.shuffle(offsets)
    assert found(offset_runs(envelopes(spark, offsets).repartition(3))) == expected_runs(offsets)


def test_runs_across_words_and_chunks(spark):
    assert found(offset_runs(envelopes(spark, range(60_000, 140_000)))) == [(60_000, 139_999)]


def test_position_waits_for_a_hole(spark):
    runs = consumed_before(spark.createDataFrame([("t", 0, 5)], STARTS))
    for batch, position, missing in [(range(10, 20), 4, [(5, 9)]), (range(5, 8), 7, [(8, 9)]), (range(8, 12), 19, []), (range(0, 3), 19, [])]:
        runs = spark.createDataFrame(advance(runs, envelopes(spark, batch)).collect(), RUNS)
        assert as_dict(reached(runs), "last_offset") == {("t", 0): position}
        assert found(holes(runs)) == missing
    skipped = advance(consumed_before(spark.createDataFrame([("t", 0, 5)], STARTS)), envelopes(spark, range(10, 20)), "skip")
    assert as_dict(reached(skipped), "last_offset") == {("t", 0): 19}


def test_merge_of_runs_that_touch_or_overlap(spark):
    rows = [("t", 0, 0, 4), ("t", 0, 5, 9), ("t", 0, 7, 8), ("t", 0, 12, 14), ("t", 1, 3, 3)]
    assert sorted(map(tuple, merge_runs(spark.createDataFrame(rows, RUNS)).collect())) == [("t", 0, 0, 9), ("t", 0, 12, 14), ("t", 1, 3, 3)]


# --- streams ---


def run(spark, source, starts, out, sink=None, **options):
    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/rows/batch_id={batch_id}")

    groups = GroupTable(spark, f"{out}/groups")
    query = start_grouped(
        spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", 1).parquet(source), starts, sink or write,
        groups=groups, group_id="g", checkpoint=f"{out}/checkpoint", state=f"{out}/state", trigger={"availableNow": True}, **options,
    )
    query.awaitTermination()
    return as_dict(groups.latest("g"), "last_offset")


def put(spark, source, offsets, partition=0):
    envelopes(spark, offsets, partition=partition).coalesce(1).write.mode("append").parquet(source)


def test_files_out_of_order_and_a_replay(spark, tmp_path):
    source, starts = str(tmp_path / "in"), spark.createDataFrame([("t", 0, 5)], STARTS)
    put(spark, source, range(0, 10))
    put(spark, source, range(20, 30))
    assert run(spark, source, starts, tmp_path) == {("t", 0): 9}
    put(spark, source, range(10, 20))
    assert run(spark, source, starts, tmp_path) == {("t", 0): 29}
    commits = GroupTable(spark, f"{tmp_path}/groups").commits("g").count()
    assert run(spark, source, starts, tmp_path) == {("t", 0): 29}
    assert GroupTable(spark, f"{tmp_path}/groups").commits("g").count() == commits
    rows = spark.read.parquet(f"{tmp_path}/rows").select("_offset").collect()
    assert sorted(r._offset for r in rows) == list(range(5, 30))


def test_failed_sink_commits_nothing(spark, tmp_path):
    source, starts = str(tmp_path / "in"), spark.createDataFrame([("t", 0, 0)], STARTS)
    put(spark, source, range(0, 10))

    def broken(batch, batch_id):
        raise RuntimeError("disk full")

    with pytest.raises(Exception, match="disk full"):
        run(spark, source, starts, tmp_path, broken)
    assert run(spark, source, starts, tmp_path) == {("t", 0): 9}


def test_holes_can_fail_the_batch(spark, tmp_path):
    source, starts = str(tmp_path / "in"), spark.createDataFrame([("t", 0, 0)], STARTS)
    put(spark, source, [0, 1, 5])
    with pytest.raises(Exception, match="t/0: offsets 2 to 4 are missing"):
        run(spark, source, starts, tmp_path, on_holes="fail")
    with pytest.raises(ValueError, match="on_holes"):
        run(spark, source, starts, tmp_path, on_holes="maybe")


def test_new_partitions(spark, tmp_path):
    source, starts = str(tmp_path / "in"), spark.createDataFrame([("t", 0, 0)], STARTS)
    put(spark, source, range(3))
    put(spark, source, range(4), partition=1)
    with pytest.raises(Exception, match="partition has no start offset: t/1"):
        run(spark, source, starts, tmp_path / "strict")
    assert run(spark, source, starts, tmp_path / "open", new_partitions=True) == {("t", 0): 2, ("t", 1): 3}


# --- history of a group ---


def test_history_is_not_read(spark, tmp_path):
    """1,000 commits, a partial one and a rewind at the end: the files of two commits are read."""
    from tidelog.sources.files import touch

    table = GroupTable(spark, str(tmp_path / "groups"))
    begin = datetime(2024, 1, 1)
    at = spark.createDataFrame([("a", 0, 7), ("a", 1, 9)], OFFSETS)
    for no in range(1000):
        name = Marker(int((begin + timedelta(seconds=no)).timestamp() * 1e6), no, "old", True, "0").name
        (tmp_path / "groups" / "_order" / "group_id=g").mkdir(parents=True, exist_ok=True)
        (tmp_path / "groups" / "_order" / "group_id=g" / name).write_text("")
    assert table.commit("other", "q", 0, at)
    # The folders of the old commits do not exist, so that reading any of them would fail.
    touch(spark, f"{table.path}/_order/group_id=g/{Marker(int(begin.timestamp() * 1e6) + 10**10, 0, 'q', True, '0').name}")
    rows = at.selectExpr("'g' AS group_id", "'q' AS query_id", "0L AS batch_id", "timestamp'2024-01-02' AS committed_at", "*")
    rows.coalesce(1).write.partitionBy("group_id", "query_id", "batch_id").mode("append").parquet(table.path)
    assert as_dict(table.latest("g"), "last_offset") == {("a", 0): 7, ("a", 1): 9}
    table.commit("g", "q", 1, spark.createDataFrame([("a", 0, 2)], OFFSETS), datetime(2024, 2, 1))
    assert as_dict(table.latest("g"), "last_offset") == {("a", 0): 2, ("a", 1): 9}
    assert len({f.rpartition("/")[0] for f in table.latest("g").inputFiles()}) == 2
    seen = GroupLog(table.path)
    assert seen.newest("g") == {"a": {"0": 2, "1": 9}} and seen.files_read == 2


def test_markers():
    markers = [Marker(5, 1, "q/ü=1", True, "0"), Marker(7, 0, "p", False, "ab"), Marker(7, 2, "p", False, "0")]
    assert parse_markers([m.name for m in markers] + ["_SUCCESS", ".x.crc"]) == sorted(markers, reverse=True)
    assert [m.committed for m in decisive(parse_markers([m.name for m in markers]))] == [7, 7, 5]
    assert decisive([markers[0], *markers]) == [markers[0]]
    with pytest.raises(ValueError, match="too long"):
        _ = Marker(1, 1, "q" * 300, True, "0").name


def test_replayed_source_commit_does_not_overrule_a_rewind(spark, root):
    from tidelog.options import ReadOptions

    log = write_log(spark, root, [(i, "a", 0) for i in range(20)])

    def source():
        return TopicLogStreamReader(ReadOptions.parse({"path": root, "topics": "a", "group.id": "g", "auto.offset.reset": "smallest"}))

    first = source()
    first.initialOffset()
    first.commit({"a": {"0": 20}})
    groups = GroupTable(spark, log.groups_path)
    groups.commit("g", "manual", 0, spark.createDataFrame([("a", 0, 4)], OFFSETS))
    source().commit({"a": {"0": 20}})  # what Spark repeats after a restart from the checkpoint
    assert as_dict(groups.latest("g"), "last_offset") == {("a", 0): 4}
    fresh = source()
    assert fresh.initialOffset() == {"a": {"0": 5}}
    fresh.commit({"a": {"0": 20}})  # a stream that began at the rewound position and came here again
    assert as_dict(groups.latest("g"), "last_offset") == {("a", 0): 19}


# --- appends of sparse ids ---


def test_sparse_ids_make_few_chunks(spark, root):
    from tidelog.operators.numbering import chunk_bounds, number_offsets

    ids = [(i * 1_000_003 % 2_147_483_647) * 2**32 for i in range(3000)]
    frame = records(spark, [(i, "hot", 0) for i in ids] + [(ids[0] + 1, "cold", 0)])
    bounds = {(r._topic, r._partition): r.bounds for r in chunk_bounds(frame, "id", 8).collect()}
    assert set(bounds) == {("hot", 0)} and 8 <= len(bounds["hot", 0]) <= 12
    ordered = sorted(ids)
    sizes = [sum(a <= i < b for i in ordered) for a, b in zip([ordered[0], *bounds["hot", 0]], [*bounds["hot", 0], 2**63])]
    assert max(sizes) < 2 * 256
    numbered = number_offsets(frame, "id", spark.createDataFrame([], STARTS), 4, 8)
    got = {r.id: r._offset for r in numbered.where("_topic = 'hot'").collect()}
    assert got == {i: no for no, i in enumerate(ordered)}
