"""Where intermediate tables go."""

from types import SimpleNamespace

import pytest

from tidelog.scratch import scratch, shared_folder


def session(master, **conf):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: conf.get(key.replace(".", "_"), default)),
        sparkContext=SimpleNamespace(master=master),
    )


def test_named_folder_is_used():
    cluster = session("spark://host:7077", spark_checkpoint_dir="hdfs:///shared/")
    assert shared_folder(cluster) == "hdfs:///shared"
    assert scratch(cluster).startswith("hdfs:///shared/tidelog-")
    assert scratch(cluster) != scratch(cluster)


def test_cluster_needs_a_named_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://host:7077"))


def test_local_session_falls_back():
    assert shared_folder(session("local[2]")) == shared_folder(session("local[2]"))
