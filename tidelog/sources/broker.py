"""Live brokers through Spark's own broker source.

Only the option mapping and the projection are ours. The connector jar must be on
the class path, and it needs brokers that speak the current protocol.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tidelog.functions.offset_json import encode_offsets
from tidelog.operators.envelope import to_envelope
from tidelog.options import LARGEST, SMALLEST, choice, int_option, parse_brokers, parse_topics, required

# Column names of Spark's source and the envelope's.
COLUMNS = {
    "key": "_key",
    "value": "_message",
    "topic": "_topic",
    "partition": "_partition",
    "offset": "_offset",
}


def broker_options(options: Mapping[str, str], starting_offsets: str | None = None) -> dict[str, str]:
    """Reader options in the names of Spark's source.

    ``starting_offsets`` is JSON of *next* offsets, see :func:`starting_offsets`;
    without it the reset policy decides. A restored checkpoint overrules both.
    """
    int_option(options, "auto.commit.interval.ms", 90_000)
    reset = choice(options, "auto.offset.reset", (SMALLEST, LARGEST), LARGEST)
    return {
        "subscribe": ",".join(parse_topics(required(options, "topics"))),
        "kafka.bootstrap.servers": ",".join(parse_brokers(required(options, "bootstrap.servers"))),
        "kafka.group.id": required(options, "group.id"),
        "startingOffsets": starting_offsets or ("earliest" if reset == SMALLEST else "latest"),
    }


def starting_offsets(starts: DataFrame) -> str:
    """Resolved starts as the JSON Spark's source expects."""
    return encode_offsets(starts, "next_offset").first()["offsets"]


def from_broker(records: DataFrame) -> DataFrame:
    """Envelope view of rows with the columns of Spark's source."""
    return to_envelope(records.withColumnsRenamed(COLUMNS))


def read_broker_stream(
    spark: SparkSession, options: Mapping[str, str], starts: DataFrame | None = None
) -> DataFrame:
    """Streaming envelopes from live brokers; allows continuous triggers."""
    first = None if starts is None else starting_offsets(starts)
    return from_broker(
        spark.readStream.format("kafka").options(**broker_options(options, first)).load()
    )
