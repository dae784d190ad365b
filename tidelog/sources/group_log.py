"""Order of a group's commits, and the committed positions as the Python source sees them.

Below ``groups/_order/group_id=<g>`` every commit leaves an empty file, a marker, whose name tells when it was made, by which
query and batch, and whether it covered every partition that the group had positions of. Names are listed, not read. Going
through them newest first, the newest position of each partition is known at the first complete commit, so a reader opens the
files of one commit in the usual case, however long the history is. Rewinds are commits like others.
"""

from __future__ import annotations

import base64
import hashlib
import re
import time
from collections.abc import Iterable
from datetime import datetime
from typing import NamedTuple

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.parquet as pq

from tidelog.sources.files import arrow_children, directory, open_arrow

ORDER = "_order"
#: Longest file name of common file systems, in bytes.
NAME_BYTES = 255


class Marker(NamedTuple):
    committed: int  # microseconds
    batch_id: int
    query_id: str
    complete: bool
    digest: str  # of the positions; "0" where nobody asks for it

    @property
    def name(self) -> str:
        query = base64.urlsafe_b64encode(self.query_id.encode()).decode().rstrip("=")
        name = f"{self.committed:020d}.{self.batch_id:020d}.{'all' if self.complete else 'some'}.{self.digest}.{query}"
        if len(name) > NAME_BYTES:
            raise ValueError(f"query id of {len(self.query_id)} characters is too long")
        return name

    @property
    def folder(self) -> str:
        """The commit's folder below the group's."""
        return f"{directory('query_id', self.query_id)}/batch_id={self.batch_id}"


def parse_markers(names: Iterable[str]) -> list[Marker]:
    """Markers of file names, newest first."""
    found = []
    for name in names:
        match = re.fullmatch(r"(\d+)\.(\d+)\.(all|some)\.([0-9a-f]+)\.([\w-]+)", name)
        if match:
            query = base64.urlsafe_b64decode(match[5] + "=" * (-len(match[5]) % 4)).decode()
            found.append(Marker(int(match[1]), int(match[2]), query, match[3] == "all", match[4]))
    return sorted(found, reverse=True)


def decisive(markers: list[Marker]) -> list[Marker]:
    """The markers, newest first, whose commits hold the newest position of every partition."""
    taken: list[Marker] = []
    seen: set[tuple[str, int]] = set()
    for marker in markers:
        # A replay overwrites its own commit, which counts where its newest marker stands.
        if (marker.query_id, marker.batch_id) in seen:
            continue
        seen.add((marker.query_id, marker.batch_id))
        taken.append(marker)
        if marker.complete:
            break
    return taken


def position_digest(positions: dict[str, dict[str, int]]) -> str:
    lines = sorted(f"{topic}\n{p}\n{last}" for topic, parts in positions.items() for p, last in parts.items())
    return hashlib.sha256("\n\n".join(lines).encode()).hexdigest()[:16]


class GroupLog:
    """Committed positions through Arrow, without a session."""

    def __init__(self, path: str):
        self.path = path
        self.files_read = 0

    def _markers(self, group_id: str) -> list[Marker]:
        return parse_markers(arrow_children(f"{self.path}/{ORDER}/{directory('group_id', group_id)}"))

    def newest(self, group_id: str) -> dict[str, dict[str, int]]:
        """Newest committed ``last_offset`` by partition."""
        group = directory("group_id", group_id)
        newest: dict[str, dict[str, int]] = {}
        for marker in decisive(self._markers(group_id)):
            filesystem, base = open_arrow(f"{self.path}/{group}/{marker.folder}")
            table = ds.dataset(base, filesystem=filesystem, format="parquet").to_table(columns=["_topic", "_partition", "last_offset"])
            self.files_read += 1
            for topic, partition, last in zip(*(table[c].to_pylist() for c in table.column_names)):
                newest.setdefault(topic, {}).setdefault(str(partition), last)
        return newest

    def held(self, group_id: str, positions: dict[str, dict[str, int]]) -> bool:
        """Whether a source has committed exactly these positions before."""
        digest = position_digest(positions)
        return any(marker.digest == digest for marker in self._markers(group_id))

    def commit(self, group_id: str, query_id: str, positions: dict[str, dict[str, int]], when: datetime) -> None:
        group = directory("group_id", group_id)
        known = self.newest(group_id)
        complete = all(p in positions.get(topic, {}) for topic, parts in known.items() for p in parts)
        rows = [(topic, int(p), last) for topic, parts in positions.items() for p, last in parts.items()]
        table = pa.table(
            {
                "committed_at": pa.array([when] * len(rows), pa.timestamp("us", "UTC")),
                "_topic": pa.array([topic for topic, _, _ in rows], pa.string()),
                "_partition": pa.array([partition for _, partition, _ in rows], pa.int32()),
                "last_offset": pa.array([last for _, _, last in rows], pa.int64()),
            }
        )
        marker = Marker(microseconds(when), time.time_ns(), query_id, complete, position_digest(positions))
        filesystem, base = open_arrow(self.path)
        folder = f"{base}/{group}/{marker.folder}"
        filesystem.create_dir(folder, recursive=True)
        # Readers skip names that begin with an underscore, so they never see a half-written file.
        pq.write_table(table, f"{folder}/_offsets.tmp", filesystem=filesystem)
        filesystem.move(f"{folder}/_offsets.tmp", f"{folder}/offsets.parquet")
        order = f"{base}/{ORDER}/{group}"
        filesystem.create_dir(order, recursive=True)
        filesystem.open_output_stream(f"{order}/{marker.name}").close()


def microseconds(when: datetime) -> int:
    return round(when.timestamp() * 1_000_000)
