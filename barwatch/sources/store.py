"""Folders in any file system that Spark reads, and versioned publishing."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from barwatch.session import path_exists


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it does not exist."""
    if not path_exists(spark, path):
        return []
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def publish(spark: SparkSession, root: str, write: Callable[[str], None]) -> int:
    """``write(folder)`` fills a new folder under ``root``; then the version's marker
    is created, in one step that fails if the number is taken. A reader sees a
    version whole or not at all; a writer that dies leaves a folder without a marker."""
    version = 1 + max((int(n.split("-", 1)[0]) for n in names_in(spark, f"{root}/_published")), default=0)
    name = f"v{version:09d}-{uuid.uuid4().hex[:8]}"
    write(f"{root}/{name}")
    fs, p = _fs(spark, f"{root}/_published")
    fs.mkdirs(p)
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/_published/{version:09d}")
    out = fs.create(marker, False)                                       # an error if another writer took the number
    out.write(bytearray(name.encode()))
    out.close()
    return version


def published(spark: SparkSession, root: str, version: int | None = None) -> str | None:
    """Folder of a version (default: the newest); None if nothing is published."""
    known = [n for n in names_in(spark, f"{root}/_published") if version is None or int(n) == version]
    if not known:
        return None
    return f"{root}/{spark.read.text(f'{root}/_published/{known[-1]}').first()[0]}"
