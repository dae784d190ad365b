import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidelog.sources import TopicLog  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tidelog-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "log")


def records(spark, rows):
    """Unnumbered records from ``(id, topic, partition)``, with the id as key and payload."""
    table = spark.createDataFrame(rows, "id bigint, _topic string, _partition int")
    return table.selectExpr(
        "cast(cast(id as string) as binary) AS _key",
        "cast(concat('m', id) as binary) AS _message",
        "_topic",
        "_partition",
        "id",
    )


def write_log(spark, root, rows, **options):
    log = TopicLog(spark, root)
    options = {"chunk_bits": 2, **options}
    log.append(records(spark, rows), "id", **options)
    return log


def offsets_of(frame):
    """``{(topic, partition): [offsets]}`` of envelope rows."""
    found = {}
    for row in frame.select("_topic", "_partition", "_offset").collect():
        found.setdefault((row._topic, row._partition), []).append(row._offset)
    return {key: sorted(values) for key, values in found.items()}


def as_dict(frame, column):
    return {(row._topic, row._partition): row[column] for row in frame.collect()}
