"""Relations that are replaced as a whole, all at once, and stay readable meanwhile.

Below a root there are

- ``<relation>/run=<run>/...``: what one run has written, never changed after it;
- ``versions/v=<N>/``: two small tables, which folders make up each relation in
  this version, and which source files it has seen; and the file ``READY``.

A run writes its folders first. Creating ``READY`` is the switch: one small file,
for all relations together. A run that fails before it leaves readers with the
version before. A version takes over the folders that its run did not rewrite. One
writer at a time is assumed; two that try fail at the same number.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Collection, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from farebox import storage
from farebox.sinks import write_parquet

READY = "READY"
FILES = "unit string, path string, length bigint, modified bigint, settings string"
PARTS = "relation string, folder string"


@dataclass(frozen=True, order=True)
class Part:
    """A folder of a relation: ``run=.../column=value/...``."""

    relation: str
    folder: str

    @property
    def values(self) -> dict[str, str]:
        return dict(level.split("=", 1) for level in self.folder.split("/"))


@dataclass(frozen=True)
class SourceFile:
    """A source file as a version has seen it; ``unit`` is the month whose change makes it read again."""

    unit: str
    path: str
    length: int
    modified: int


@dataclass(frozen=True)
class Version:
    number: int
    settings: str
    files: frozenset[SourceFile]
    parts: frozenset[Part]

    def of(self, relation: str) -> list[Part]:
        return sorted(part for part in self.parts if part.relation == relation)


def new_run() -> str:
    """Name of a run: not a number, so that it is never read as one."""
    return f"r-{uuid.uuid4().hex}"


def write_parts(df: DataFrame, root: str, relation: str, run: str, partition_by: Sequence[str] = ()) -> list[Part]:
    """Write what a run contributes to a relation, and list its folders. No version has them yet."""
    path = f"{root}/{relation}/run={run}"
    write_parquet(df, path, partition_by)
    files = df.sparkSession.read.schema(df.schema).parquet(path).inputFiles()
    return sorted({Part(relation, re.search(r"/(run=[^/]+(?:/[^/]+=[^/]*)*)/[^/]+$", file)[1]) for file in files})


def read_parts(
    spark: SparkSession, root: str, parts: Iterable[Part], schema: StructType, levels: Sequence[str] = ()
) -> DataFrame:
    """The rows in some parts of one relation; ``levels`` names partition columns that ``schema`` lacks."""
    parts = sorted(parts)
    extra = StructType([StructField(name, StringType()) for name in levels])
    whole = StructType([*schema.fields, *extra.fields, StructField("run", StringType())])
    if not parts:
        return spark.createDataFrame([], whole).drop("run")
    base = f"{root}/{parts[0].relation}"
    read = spark.read.schema(whole).option("basePath", base)
    return read.parquet(*[f"{base}/{part.folder}" for part in parts]).select(*schema.names, *levels)


def current(spark: SparkSession, root: str) -> Version | None:
    """The newest complete version."""
    ready = storage.complete(spark, f"{root}/versions", READY)
    return _load(spark, root, ready[-1]) if ready else None


def _load(spark: SparkSession, root: str, number: int) -> Version:
    folder = f"{root}/versions/v={number}"
    files = spark.read.schema(FILES).parquet(f"{folder}/files").collect()
    parts = spark.read.schema(PARTS).parquet(f"{folder}/parts").collect()
    return Version(
        number,
        files[0].settings if files else "",
        frozenset(SourceFile(f.unit, f.path, f.length, f.modified) for f in files),
        frozenset(Part(p.relation, p.folder) for p in parts),
    )


def publish(
    spark: SparkSession, root: str, settings: str, files: Collection[SourceFile], parts: Collection[Part]
) -> Version:
    """Make a new version of the given folders and switch readers to it."""
    number = storage.next_number(spark, f"{root}/versions")
    folder = f"{root}/versions/v={number}"
    seen = [(f.unit, f.path, f.length, f.modified, settings) for f in files]
    spark.createDataFrame(seen, FILES).coalesce(1).write.parquet(f"{folder}/files")
    spark.createDataFrame([(p.relation, p.folder) for p in parts], PARTS).coalesce(1).write.parquet(f"{folder}/parts")
    storage.touch(spark, f"{folder}/{READY}")
    return Version(number, settings, frozenset(files), frozenset(parts))


def drop_old(spark: SparkSession, root: str, keep: int) -> None:
    """Delete all but the newest ``keep`` versions, and the folders that only those had.

    Readers that opened an older version lose it; folders of unfinished runs are left alone.
    """
    ready = storage.complete(spark, f"{root}/versions", READY)
    kept, dropped = ready[-keep:], ready[:-keep]
    needed = set().union(*(_load(spark, root, n).parts for n in kept)) if dropped else set()
    for number in dropped:
        stale = {part for part in _load(spark, root, number).parts if part not in needed}
        # no longer a version before its folders go
        storage.delete(spark, f"{root}/versions/v={number}/{READY}")
        for part in sorted(stale):
            storage.delete(spark, f"{root}/{part.relation}/{part.folder}")
        storage.delete(spark, f"{root}/versions/v={number}")
