"""Looking at folders: through Hadoop where there is a session, else through Arrow."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyarrow import fs
from pyspark.sql import SparkSession


# Characters that Spark writes as %XX in the directory name of a partition value.
ESCAPED = frozenset([*map(chr, range(1, 32)), *"\"#%'*/:=?\\\x7f{[]^"])


def directory(column: str, value: str) -> str:
    """Name of the directory that holds the rows of one partition value."""
    return f"{column}=" + "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in value)


def numbers(names: Iterable[str], column: str) -> list[int]:
    """Values ``n`` of the directory names ``column=n``, ascending."""
    found = (re.fullmatch(rf"{column}=(\d+)", name) for name in names)
    return sorted(int(match.group(1)) for match in found if match)


# --- on the driver, with the file systems the cluster is set up for ---


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    place, filesystem = _hadoop(spark, path)
    return filesystem.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    place, filesystem = _hadoop(spark, path)
    if not filesystem.exists(place):
        return []
    return [status.getPath().getName() for status in filesystem.listStatus(place)]


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder, in one call to the JVM; for names without commas and spaces."""
    place, filesystem = _hadoop(spark, path)
    if not filesystem.exists(place):
        return []
    paths = spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(filesystem.listStatus(place))
    listed = spark._jvm.scala.runtime.ScalaRunTime.stringOf(paths).removeprefix("Array(").removesuffix(")")
    return [name.rpartition("/")[2] for name in listed.split(", ")] if listed else []


def touch(spark: SparkSession, path: str) -> None:
    """Make an empty file."""
    place, filesystem = _hadoop(spark, path)
    filesystem.create(place, True).close()


def default_file_system(spark: SparkSession) -> str:
    """Where Hadoop looks for paths without a scheme."""
    return spark._jsparkSession.sessionState().newHadoopConf().get("fs.defaultFS", "file:///")


def on_file_system(path: str, file_system: str) -> str:
    """``path`` as Hadoop would read it, with a scheme unless it is local."""
    if "://" in path or path.startswith("file:") or file_system.startswith("file:"):
        return path
    if not path.startswith("/"):
        raise ValueError(f"path '{path}' needs a scheme or a leading slash")
    return file_system.rstrip("/") + path


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether the Spark job that wrote the folder has finished."""
    return exists(spark, f"{path}/_SUCCESS")


# --- inside the Python source, which has no session ---


def open_arrow(path: str) -> tuple[fs.FileSystem, str]:
    """File system and plain path of a local path or URI."""
    if path.startswith("file:"):
        path = "file:///" + path[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


def arrow_children(path: str) -> list[str]:
    filesystem, base = open_arrow(path)
    return [e.base_name for e in filesystem.get_file_info(fs.FileSelector(base, allow_not_found=True))]


def arrow_exists(path: str) -> bool:
    filesystem, base = open_arrow(path)
    return filesystem.get_file_info(base).type != fs.FileType.NotFound
