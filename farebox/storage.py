"""Small file operations in any store that Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, folder: str) -> list[str]:
    """Sorted names in a folder; none if there is no such folder."""
    store, where = _open(spark, folder)
    return sorted(found.getPath().getName() for found in store.listStatus(where)) if store.exists(where) else []


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file, which must not exist."""
    store, where = _open(spark, path)
    store.create(where, False).close()


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if there."""
    store, where = _open(spark, path)
    store.delete(where, True)


def complete(spark: SparkSession, folder: str, marker: str) -> list[int]:
    """Ascending numbers N of the subfolders ``v=N`` that hold the file ``marker``."""
    found = [int(name.removeprefix("v=")) for name in names(spark, folder) if name.startswith("v=")]
    return [n for n in sorted(found) if marker in names(spark, f"{folder}/v={n}")]


def next_number(spark: SparkSession, folder: str) -> int:
    """One more than the largest N of the subfolders ``v=N``, complete or not."""
    return max((int(name.removeprefix("v=")) for name in names(spark, folder) if name.startswith("v=")), default=0) + 1
