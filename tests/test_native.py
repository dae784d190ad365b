"""File-source streaming with group commits."""

import pytest

from tests.conftest import as_dict, offsets_of, records, write_log
from tidelog.operators import resolve_starts
from tidelog.schema import KEY, STARTS
from tidelog.sources import GroupTable, TopicLog
from tidelog.streaming import BatchState, contiguous_offsets, freeze_starts, start_committing

ROWS = [(i, "hot" if i % 3 else "cold", i % 2 if i % 3 == 0 else 0) for i in range(300)]
TOPICS = ["hot", "cold"]


def starts(spark, *rows):
    return spark.createDataFrame(list(rows), STARTS)


def run(log, begin, out, sink=None, **options):
    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/rows/batch_id={batch_id}")

    query = start_committing(
        log, TOPICS, begin, sink or write,
        group_id="g", checkpoint=f"{out}/checkpoint", trigger={"availableNow": True}, **options,
    )
    query.awaitTermination()


def position(log):
    return as_dict(GroupTable(log.spark, log.groups_path).latest("g"), "last_offset")


ALL = [("hot", 0, 0), ("cold", 0, 0), ("cold", 1, 0)]


def test_many_batches_and_restart(spark, root, tmp_path):
    log = write_log(spark, root, ROWS, rows_per_file=40)
    begin = starts(spark, ("hot", 0, 150), ("cold", 0, 0), ("cold", 1, 50))
    run(log, begin, tmp_path, max_files_per_trigger=2)
    assert position(log) == {("hot", 0): 199, ("cold", 0): 49, ("cold", 1): 49}
    log.append(records(spark, [(1000 + i, "hot", 0) for i in range(6)]), "id", chunk_bits=2)
    run(log, begin, tmp_path)
    assert offsets_of(spark.read.parquet(f"{tmp_path}/rows")) == {
        ("hot", 0): list(range(150, 206)),
        ("cold", 0): list(range(50)),
    }
    assert position(log)["hot", 0] == 205


def grown(spark, root, appends=3):
    log = TopicLog(spark, root)
    for no in range(appends):
        log.append(records(spark, [(100 * no + i, "hot", 0) for i in range(10)] + [(100 * no + 50, "cold", no % 2)]), "id", chunk_bits=2)
    return log


def test_position_comes_from_the_manifest(spark, root):
    log = grown(spark, root)
    begin = starts(spark, ("hot", 0, 4), ("cold", 0, 0), ("cold", 1, 0))
    reached = as_dict(contiguous_offsets(begin, log.manifest()), "last_offset")
    assert reached == {("hot", 0): 29, ("cold", 0): 1, ("cold", 1): 0}
    assert as_dict(contiguous_offsets(begin, log.manifest(after=2)), "last_offset") == {("hot", 0): 3, ("cold", 0): -1, ("cold", 1): -1}


def test_a_missing_range_is_named(spark, root):
    log = grown(spark, root)
    begin = starts(spark, ("hot", 0, 4), ("cold", 0, 0), ("cold", 1, 0))
    with pytest.raises(ValueError, match="hot/0: offsets 10 to 19 are missing"):
        contiguous_offsets(begin, log.manifest().where("_append <> 1"))


def test_stream_fails_on_a_missing_range(spark, root, tmp_path):
    log = grown(spark, root)
    manifest = tmp_path / "log" / "manifest" / "_append=1"
    held = manifest.rename(tmp_path / "held")
    begin = starts(spark, *ALL)
    with pytest.raises(Exception, match="hot/0: offsets 10 to 19 are missing"):
        run(log, begin, tmp_path)
    assert position(log) == {}
    held.rename(manifest)
    run(log, begin, tmp_path)
    assert position(log) == {("hot", 0): 29, ("cold", 0): 1, ("cold", 1): 0}


def test_appends_one_by_one_in_order(spark, root, tmp_path):
    log, begin, seen = grown(spark, root), starts(spark, *ALL), []

    def sink(batch, batch_id):
        seen.append(sorted(r._offset for r in batch.where("_topic = 'hot'").collect()))

    run(log, begin, tmp_path, sink, max_files_per_trigger=1)
    assert seen == [list(range(10)), list(range(10, 20)), list(range(20, 30))]


def test_half_written_append_and_its_retry(spark, root, tmp_path):
    log = grown(spark, root, 1)
    begin = starts(spark, *ALL)
    run(log, begin, tmp_path, new_partitions=True)
    # Data and heads of an append that failed before its manifest.
    log.rows().write.partitionBy(*KEY).parquet(f"{log.data_path}/_append=1")
    log.heads().write.parquet(f"{root}/heads/_append=1")
    run(log, begin, tmp_path)
    log.append(records(spark, [(1000 + i, "hot", 0) for i in range(5)]), "id", chunk_bits=2)
    run(log, begin, tmp_path)
    assert offsets_of(spark.read.parquet(f"{tmp_path}/rows"))["hot", 0] == list(range(15))


def test_state_of_a_replayed_batch_is_its_own(spark, root):
    log = grown(spark, root)
    state = BatchState(spark, log, "query")
    first = starts(spark, ("hot", 0, 0))
    for _ in range(2):
        state.save(0, contiguous_offsets(first, log.manifest(upto=0).where("_topic = 'hot'")), 0)
    before, done = state.load(1, first)
    assert as_dict(before, "next_offset") == {("hot", 0): 10} and done == 0
    with pytest.raises(ValueError, match="no position after batch 4"):
        state.load(5, first)


def test_commits_can_be_switched_on_later(spark, root, tmp_path):
    log = write_log(spark, root, ROWS)
    run(log, starts(spark, *ALL), tmp_path, commit=False)
    assert position(log) == {}
    log.append(records(spark, [(1000, "hot", 0)]), "id")
    run(log, starts(spark, *ALL), tmp_path)
    assert position(log) == {("hot", 0): 200, ("cold", 0): 49, ("cold", 1): 49}


def test_starts_are_resolved_once(spark, root, tmp_path):
    log = write_log(spark, root, ROWS)
    groups = GroupTable(spark, log.groups_path)

    def resolve():
        return resolve_starts(log.partitions(), groups.latest("g"), "smallest")

    path = f"{tmp_path}/starts"
    first = as_dict(freeze_starts(spark, path, resolve), "next_offset")
    groups.commit("g", "q", 0, log.partitions().selectExpr("_topic", "_partition", "latest - 1 AS last_offset"))
    assert as_dict(resolve(), "next_offset") != first
    assert as_dict(freeze_starts(spark, path, resolve), "next_offset") == first


def test_new_partition_fails_or_begins_at_zero(spark, root, tmp_path):
    log = write_log(spark, root, ROWS)
    known = starts(spark, *ALL[:2])
    with pytest.raises(Exception, match="cold/1"):
        run(log, known, tmp_path / "strict")
    run(log, known, tmp_path / "open", new_partitions=True)
    assert offsets_of(spark.read.parquet(f"{tmp_path}/open/rows"))["cold", 1] == list(range(50))
    assert position(log)["cold", 1] == 49


def test_failed_sink_commits_nothing_and_batch_is_replayed(spark, root, tmp_path):
    log = write_log(spark, root, ROWS)

    def broken(batch, batch_id):
        raise RuntimeError("disk full")

    with pytest.raises(Exception, match="disk full"):
        run(log, starts(spark, *ALL), tmp_path, broken)
    assert position(log) == {}
    run(log, starts(spark, *ALL), tmp_path)
    assert sum(map(len, offsets_of(spark.read.parquet(f"{tmp_path}/rows")).values())) == 300
    assert position(log)["hot", 0] == 199


def test_failed_commit_fails_the_batch(spark, root, tmp_path):
    log = write_log(spark, root, ROWS)
    (tmp_path / "log" / "groups").write_text("not a folder")
    with pytest.raises(Exception):
        run(log, starts(spark, *ALL), tmp_path)


def test_commit_can_be_switched_off(spark, root, tmp_path):
    log = write_log(spark, root, ROWS)
    run(log, starts(spark, *ALL), tmp_path, commit=False)
    assert position(TopicLog(spark, root)) == {}
    assert sum(map(len, offsets_of(spark.read.parquet(f"{tmp_path}/rows")).values())) == 300
