"""Topic-log analytics on Spark."""

from tidelog.options import ReadOptions
from tidelog.schema import ENVELOPE
from tidelog.sources import GroupTable, TopicLog, register

__all__ = ["ENVELOPE", "GroupTable", "ReadOptions", "TopicLog", "register"]
