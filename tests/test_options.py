import pytest

from tidelog.options import ReadOptions, int_option, parse_brokers, parse_topics

BASE = {"path": "/x/", "topics": "b, a,b", "group.id": "g"}


def test_defaults_and_dedup():
    options = ReadOptions.parse(BASE)
    assert options.topics == ("b", "a")
    assert (options.path, options.reset, options.commit) == ("/x", "largest", True)
    assert options.on_new_partition == "fail"


def test_keys_ignore_case():
    options = ReadOptions.parse({**BASE, "ROWSPERTASK": "7", "Auto.Offset.Reset": "smallest"})
    assert (options.rows_per_task, options.reset) == (7, "smallest")


@pytest.mark.parametrize("missing", ["path", "topics", "group.id"])
def test_required(missing):
    with pytest.raises(ValueError, match=missing):
        ReadOptions.parse({key: value for key, value in BASE.items() if key != missing})


@pytest.mark.parametrize(
    "extra",
    [
        {"auto.offset.reset": "middle"},
        {"auto.commit.interval.ms": "soon"},
        {"rowsPerTask": "0"},
        {"commit": "maybe"},
        {"onNewPartition": "skip"},
    ],
)
def test_bad_values(extra):
    with pytest.raises(ValueError, match=next(iter(extra))):
        ReadOptions.parse({**BASE, **extra})


def test_topics_need_a_name():
    assert parse_topics("a") == ("a",)
    with pytest.raises(ValueError):
        parse_topics(" , ,")


def test_int_option():
    assert int_option({}, "n", 5) == 5
    assert int_option({"n": "6"}, "n", 5) == 6
    with pytest.raises(ValueError, match="'n' must be an integer"):
        int_option({"n": "x"}, "n", 5)


def test_values_are_not_printed():
    assert "secret" not in repr(ReadOptions.parse({**BASE, "group.id": "secret"}))


def test_brokers():
    assert parse_brokers("h1:9092, [::1]:9093") == ("h1:9092", "[::1]:9093")


@pytest.mark.parametrize("text", ["", "h1", ":9092", "h1:port", "h1:99999", "h1:1/x", "u@h1:1", "h1:1,,h2:2"])
def test_bad_brokers(text):
    with pytest.raises(ValueError, match="broker address"):
        parse_brokers(text)
