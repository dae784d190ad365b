from tidelog.operators.discovery import discover, discover_from_manifest, discover_topics
from tidelog.operators.envelope import offset_range, subscribe, to_envelope
from tidelog.operators.numbering import number_offsets
from tidelog.operators.pin import Pinned, pin
from tidelog.operators.progress import compare_offsets, merge_offsets, offsets_equal, progress
from tidelog.operators.runs import holes, merge_runs, offset_runs
from tidelog.operators.scan import after_starts
from tidelog.operators.starts import (
    add_new_partitions,
    require_starts,
    resolve_starts,
    start_problems,
    starts_after,
)

__all__ = [
    "Pinned",
    "add_new_partitions",
    "after_starts",
    "compare_offsets",
    "discover",
    "discover_from_manifest",
    "discover_topics",
    "holes",
    "merge_offsets",
    "merge_runs",
    "number_offsets",
    "offset_range",
    "offset_runs",
    "offsets_equal",
    "pin",
    "progress",
    "require_starts",
    "resolve_starts",
    "start_problems",
    "starts_after",
    "subscribe",
    "to_envelope",
]
