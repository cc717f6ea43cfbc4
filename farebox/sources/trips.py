"""Monthly trip files as one relation.

Files of different months may store a column with different physical types
(``passenger_count`` as a long in one and a double in the next). One
``read.parquet`` over all of them cannot bridge that, so files are grouped by
the types of the declared columns, each group is one scan that is cast to the
declared types, and the few groups are united. Every scan still prunes columns
and pushes filters.

Every file must have every declared column: a column that one file lacks would
be read as NULL there, and its trips would silently fail the validity rule.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from farebox.functions.time import calendar_parts
from farebox.schemas import PICKUP, POSITION, RAW_TRIPS, SOURCE_MONTH, conform
from farebox.sinks import PICKUP_MONTH, cluster
from farebox.sources.footers import listed_files, read_footers

#: Files named in an error message.
NAMED_FILES = 5


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Paths of the files behind a path or glob, as a ``path`` column; only the listing is read."""
    return listed_files(spark, pattern).select("path")


def stored_columns(rows: Sequence[Row]) -> dict[tuple[str, str], list[str]]:
    """Sorted files by how they store the declared columns: a line for each column there is, and Spark's schema."""
    groups: dict[tuple[str, str], list[str]] = {}
    for row in sorted(rows, key=lambda row: row.path):
        groups.setdefault((row.stored, row.physical), []).append(row.path)
    return groups


def _require_columns(groups: dict[tuple[str, str], list[str]], declared: StructType, optional: Sequence[str]) -> None:
    """Raise if any file lacks a declared column that isn't optional, and name both."""
    faults = []
    for (stored, _), files in groups.items():
        there = {line.split(" ")[0] for line in stored.split("\n")}
        missing = [f.name for f in declared if f.name.lower() not in there and f.name not in optional]
        if missing:
            more = f" and {len(files) - NAMED_FILES} more" if len(files) > NAMED_FILES else ""
            faults.append(f"missing columns {missing} in {files[:NAMED_FILES]}{more}")
    if faults:
        raise ValueError("; ".join(faults))


def _physical(schema: StructType, declared: StructType) -> StructType:
    """The fields of ``declared`` with the types ``schema`` stores them in (optional ones may be absent)."""
    stored = {field.name.lower(): field.dataType for field in schema}
    return StructType([StructField(f.name, stored.get(f.name.lower(), f.dataType)) for f in declared])


def read_trips(
    spark: SparkSession,
    *patterns: str,
    schema: StructType = RAW_TRIPS,
    positions: bool = True,
    optional: Sequence[str] = (),
) -> DataFrame:
    """All trip files behind the paths or globs, cast to ``schema``.

    A file without one of the columns is an error, unless the column is named in
    ``optional``: then it is NULL there. With ``positions`` each row carries where it lies
    in its source file, which costs nothing unless a later step reads it.
    """
    listed = reduce(DataFrame.union, (listed_files(spark, pattern) for pattern in patterns))
    found = read_footers(spark, listed, schema.names)
    if not found:
        raise FileNotFoundError(f"no trip files behind {list(patterns)}")
    return scan_trips(spark, found, schema, positions, optional)


def scan_trips(
    spark: SparkSession,
    footers: Sequence[Row],
    schema: StructType = RAW_TRIPS,
    positions: bool = True,
    optional: Sequence[str] = (),
    month_in: str | None = None,
    between: tuple[datetime, datetime] | None = None,
) -> DataFrame:
    """The trips of files whose footers are known, as ``read_trips`` gives them; no footer is opened here.

    With ``month_in``, a pattern with one group, rows also carry the month in their file's name.
    With ``between``, files whose footers rule out any pickup in [first, last) are not read; rows
    of the others are not filtered.
    """
    if between:
        first, last = between
        footers = [f for f in footers if not f.bounded or f["last"] is not None and f["first"] < last and f["last"] >= first]
    stored = stored_columns(footers)
    _require_columns(stored, schema, optional)
    groups: dict[str, tuple[StructType, list[str]]] = {}
    for (_, found), files in stored.items():
        physical = _physical(StructType.fromJson(json.loads(found)), schema)
        groups.setdefault(physical.json(), (physical, []))[1].extend(files)
    scans = [_scan(spark, files, physical, schema, positions, month_in) for physical, files in groups.values()]
    if scans:
        return reduce(DataFrame.unionByName, scans)
    extra = [StructField(POSITION[0], LongType()), StructField(POSITION[1], LongType())] * positions
    extra += [StructField(SOURCE_MONTH, StringType())] * bool(month_in)
    return spark.createDataFrame([], StructType([*schema.fields, *extra]))


def _scan(
    spark: SparkSession,
    paths: list[str],
    physical: StructType,
    schema: StructType,
    positions: bool,
    month_in: str | None,
) -> DataFrame:
    trips = spark.read.schema(physical).parquet(*paths)
    where = []
    if positions:
        where += [F.xxhash64("_metadata.file_path").alias(POSITION[0]), F.col("_metadata.row_index").alias(POSITION[1])]
    if month_in:
        where.append(month_of_file(F.col("_metadata.file_path"), month_in).alias(SOURCE_MONTH))
    return conform(trips.select("*", *where), schema)


def month_of_file(path: Column, month_in: str) -> Column:
    """The month in a file's path, ``other`` where there is none."""
    found = F.regexp_extract(path, month_in, 1)
    return F.when(found == "", "other").otherwise(found)


def registered_table(spark: SparkSession, schema: str, table: str) -> DataFrame:
    """A table known to the session's catalog."""
    return spark.table(f"{schema}.{table}")


def ingest(spark: SparkSession, pattern: str, table: str, path: str | None = None) -> DataFrame:
    """Replace a catalog table with the trips behind a glob, and return the table.

    The table is partitioned by the year and month of the pickup (trips without one have
    their own partition), its files follow the size of the months, and row count and size are
    registered for the optimizer. ``path`` places the table outside the warehouse.
    """
    trips = read_trips(spark, pattern, positions=False)
    dated = trips.select("*", *calendar_parts(PICKUP)).drop("pickup_hour")
    writer = cluster(dated, PICKUP_MONTH).write.mode("overwrite").partitionBy(*PICKUP_MONTH)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    return spark.table(table)
