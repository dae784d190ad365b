"""Column expressions over the binary key and payload."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text(name: str) -> Column:
    """UTF-8 text of a binary envelope column; null stays null."""
    return F.col(name).cast("string")


def json_field(path: str, dtype: str, *, strict: bool = False) -> Column:
    """One field of a JSON payload as ``dtype``; a value that does not fit is null, or with ``strict`` an error."""
    field = F.get_json_object(text("_message"), path)
    return field.cast(dtype) if strict else field.try_cast(dtype)


def is_tombstone() -> Column:
    """A null payload marks the deletion of its key."""
    return F.col("_message").isNull()
