from tidelog.sources.broker import broker_options, from_broker, read_broker_stream, starting_offsets
from tidelog.sources.checkpoints import checkpoint_starts
from tidelog.sources.group_table import GroupTable
from tidelog.sources.log_table import TopicLog
from tidelog.sources.topiclog import TopicLogSource, register

__all__ = [
    "GroupTable",
    "TopicLog",
    "TopicLogSource",
    "broker_options",
    "checkpoint_starts",
    "from_broker",
    "read_broker_stream",
    "register",
    "starting_offsets",
]
