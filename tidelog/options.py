"""Validation of the string options a reader takes."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from urllib.parse import urlsplit

SMALLEST, LARGEST = "smallest", "largest"


def lowered(options: Mapping[str, str]) -> dict[str, str]:
    """Option names are case-insensitive, as in Spark."""
    return {key.lower(): value for key, value in options.items()}


def required(options: Mapping[str, str], key: str) -> str:
    value = lowered(options).get(key.lower())
    if value is None or not value.strip():
        raise ValueError(f"option '{key}' is required")
    return value.strip()


def int_option(options: Mapping[str, str], key: str, default: int) -> int:
    value = lowered(options).get(key.lower())
    if value is None:
        return default
    try:
        return int(value)
    except ValueError:
        raise ValueError(
            f"option '{key}' must be an integer (default {default})"
        ) from None


def bool_option(options: Mapping[str, str], key: str, default: bool) -> bool:
    value = lowered(options).get(key.lower())
    if value is None:
        return default
    if value.strip().lower() not in ("true", "false"):
        raise ValueError(f"option '{key}' must be true or false")
    return value.strip().lower() == "true"


def commit_option(options: Mapping[str, str]) -> bool:
    """``commit``, or ``auto.commit.enable`` by its older name; both must agree if both are given."""
    named = [bool_option(options, key, True) for key in ("commit", "auto.commit.enable") if key in lowered(options)]
    if len(set(named)) > 1:
        raise ValueError("options 'commit' and 'auto.commit.enable' contradict each other")
    return named[0] if named else True


def offsets_option(options: Mapping[str, str], key: str) -> str | None:
    """JSON ``{"topic": {"partition": next_offset}}``, as a checkpoint holds it."""
    value = lowered(options).get(key.lower())
    if value is None:
        return None
    try:
        parsed = json.loads(value)
        good = all(isinstance(o, int) and int(p) >= 0 for parts in parsed.values() for p, o in parts.items())
    except (ValueError, AttributeError):
        good = False
    if not good:
        raise ValueError(f"option '{key}' must be JSON of next offsets by topic and partition")
    return value


def choice(options: Mapping[str, str], key: str, allowed: tuple[str, ...], default: str) -> str:
    value = lowered(options).get(key.lower(), default).strip().lower()
    if value not in allowed:
        raise ValueError(f"option '{key}' must be one of {', '.join(allowed)}")
    return value


def parse_topics(text: str) -> tuple[str, ...]:
    """Comma list to distinct names, in order of first mention."""
    names = [name.strip() for name in text.split(",")]
    topics = tuple(dict.fromkeys(name for name in names if name))
    if not topics:
        raise ValueError("option 'topics' names no topic")
    return topics


def parse_brokers(text: str) -> tuple[str, ...]:
    """Comma list of ``host:port``; both parts must be present and valid."""
    brokers = []
    for entry in text.split(","):
        address = entry.strip()
        try:
            parts = urlsplit(f"//{address}")
            host, port = parts.hostname, parts.port
        except ValueError:
            raise ValueError(f"broker address '{address}' is not host:port") from None
        if not host:
            raise ValueError(f"broker address '{address}' has no valid host")
        if port is None:
            raise ValueError(f"broker address '{address}' has no valid port")
        if parts.netloc != address or parts.username is not None:
            raise ValueError(f"broker address '{address}' is not host:port")
        brokers.append(address)
    return tuple(brokers)


@dataclass(frozen=True, repr=False)
class ReadOptions:
    """Options of a log reader. Values are never printed, as they may hold secrets."""

    path: str
    topics: tuple[str, ...]
    group_id: str
    reset: str = LARGEST
    on_new_partition: str = "fail"
    commit: bool = True
    rows_per_task: int = 1_000_000
    bytes_per_task: int = 128 << 20
    starting_offsets: str | None = None

    @classmethod
    def parse(cls, options: Mapping[str, str]) -> ReadOptions:
        rows_per_task = int_option(options, "rowsPerTask", cls.rows_per_task)
        if rows_per_task < 1:
            raise ValueError("option 'rowsPerTask' must be positive")
        bytes_per_task = int_option(options, "bytesPerTask", cls.bytes_per_task)
        if bytes_per_task < 1:
            raise ValueError("option 'bytesPerTask' must be positive")
        # Accepted so that existing option sets load; `commit` is what decides.
        int_option(options, "auto.commit.interval.ms", 90_000)
        return cls(
            path=required(options, "path").rstrip("/"),
            topics=parse_topics(required(options, "topics")),
            group_id=required(options, "group.id"),
            reset=choice(options, "auto.offset.reset", (SMALLEST, LARGEST), LARGEST),
            on_new_partition=choice(options, "onNewPartition", ("fail", "earliest"), "fail"),
            commit=commit_option(options),
            rows_per_task=rows_per_task,
            bytes_per_task=bytes_per_task,
            starting_offsets=offsets_option(options, "startingOffsets"),
        )
