"""Option mapping and projection; no broker is contacted."""

import pytest

from tests.conftest import write_log
from tidelog.schema import ENVELOPE, STARTS
from tidelog.sources import broker_options, from_broker, read_broker_stream, starting_offsets

OPTIONS = {
    "topics": "topic1,topic2,topic1",
    "bootstrap.servers": "broker1:9092, broker2:9092",
    "group.id": "test1",
    "auto.offset.reset": "largest",
    "zookeeper.connect": "zk1:2181",
    "auto.commit.enable": "true",
    "auto.commit.interval.ms": "5000",
}


def test_option_names():
    assert broker_options(OPTIONS) == {
        "subscribe": "topic1,topic2",
        "kafka.bootstrap.servers": "broker1:9092,broker2:9092",
        "kafka.group.id": "test1",
        "startingOffsets": "latest",
    }
    smallest = broker_options({**OPTIONS, "auto.offset.reset": "smallest"})
    assert smallest["startingOffsets"] == "earliest"


@pytest.mark.parametrize("key", ["topics", "bootstrap.servers", "group.id"])
def test_required_options(key):
    with pytest.raises(ValueError, match=key):
        broker_options({name: value for name, value in OPTIONS.items() if name != key})


@pytest.mark.parametrize("key", ["auto.commit.interval.ms", "auto.offset.reset", "bootstrap.servers"])
def test_invalid_options(key):
    with pytest.raises(ValueError):
        broker_options({**OPTIONS, key: "x"})


def test_resolved_starts_are_next_offsets(spark):
    starts = spark.createDataFrame([("a", 0, 8), ("a", 10, 0), ("b", 2, 5)], STARTS)
    document = starting_offsets(starts)
    assert document == '{"a":{"0":8,"10":0},"b":{"2":5}}'
    assert broker_options(OPTIONS, document)["startingOffsets"] == document


def test_projection(spark, root):
    log = write_log(spark, root, [(i, "a", i % 2) for i in range(10)])
    names = {"_key": "key", "_message": "value", "_topic": "topic", "_partition": "partition", "_offset": "offset"}
    shaped = log.rows().withColumnsRenamed(names).selectExpr("*", "current_timestamp() AS timestamp", "0 AS timestampType")
    found = from_broker(shaped)
    assert found.columns == ENVELOPE.names
    assert sorted(found.collect()) == sorted(log.rows().collect())


def test_connector_is_asked_for(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_broker_stream(spark, OPTIONS)
