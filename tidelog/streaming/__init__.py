from tidelog.streaming.grouped import start_grouped
from tidelog.streaming.native import BatchState, contiguous_offsets, freeze_starts, start_committing

__all__ = ["BatchState", "contiguous_offsets", "freeze_starts", "start_committing", "start_grouped"]
