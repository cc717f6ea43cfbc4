"""What the footers of trip files say, and a stored table of it.

The table has one row per file: path, length and change time, how the file stores the
declared columns, its rows, and the first and last value of one timestamp. A file is
opened again only if its length or change time differ.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from farebox import storage
from farebox.schemas import PICKUP, RAW_TRIPS

LISTED = "path string, length bigint, modified bigint"
#: ``first`` and ``last`` are NULL where no row has the timestamp, and ``bounded`` is false where the footer doesn't tell.
FOUND = "stored string, rows bigint, first timestamp_ntz, last timestamp_ntz, bounded boolean"
#: ``physical`` is Spark's schema of the declared columns, as JSON; files that store them alike share it.
FOOTERS = f"{LISTED}, {FOUND}, physical string"


def listed_files(spark: SparkSession, pattern: str) -> DataFrame:
    """path, length and modified (microseconds) of the files behind a path or glob.

    Only the listing is read, not the files. A pattern without a match is empty.
    """
    try:
        listed = spark.read.format("binaryFile").load(pattern)
    except PySparkException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTED)
    return listed.select("path", "length", F.unix_micros("modificationTime").alias("modified"))


def _bounds(file, ts: str):
    """(first, last, known) of a local timestamp, from the statistics of all row groups."""
    at = next((i for i in range(len(file.schema)) if file.schema.column(i).path.lower() == ts.lower()), None)
    if at is None:
        return None, None, False
    kind = str(file.schema.column(at).logical_type).lower().replace(" ", "")
    found = []
    for group in range(file.metadata.num_row_groups):
        column = file.metadata.row_group(group).column(at)
        stats = column.statistics
        if stats is not None and stats.has_null_count and stats.null_count == column.num_values:
            continue
        if stats is None or not stats.has_min_max or "isadjustedtoutc=false" not in kind:
            return None, None, False
        found.append((pd.Timestamp(stats.min), pd.Timestamp(stats.max)))
    return min((a for a, _ in found), default=None), max((b for _, b in found), default=None), True


def _reader(names: Sequence[str], ts: str):
    """Opens the footer of each file: how it stores the columns in ``names``, its rows, and the bounds of ``ts``."""
    wanted = {name.lower() for name in names}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import ArrowException, fs, parquet

        for batch in batches:
            rows = []
            for path in batch["path"]:
                try:
                    local = re.sub("^file:/+", "/", path)
                    store, inner = (fs.LocalFileSystem(), local) if local.startswith("/") else fs.FileSystem.from_uri(path)
                    with store.open_input_file(inner) as opened:
                        file = parquet.ParquetFile(opened)
                        columns = [file.schema.column(i) for i in range(len(file.schema))]
                        stored = sorted(f"{c.path.lower()} {c.physical_type} {c.logical_type}" for c in columns if c.path.lower() in wanted)
                        rows.append(("\n".join(stored), file.metadata.num_rows, *_bounds(file, ts)))
                except (ArrowException, OSError):
                    rows.append((None, None, None, None, False))
            out = pd.DataFrame(rows, columns=["stored", "rows", "first", "last", "bounded"])
            listed = batch.reset_index(drop=True)
            yield pd.concat([listed, out.astype({"rows": "Int64", "first": "datetime64[us]", "last": "datetime64[us]"})], axis=1)

    return run


def read_footers(spark: SparkSession, listed: DataFrame, names: Sequence[str] = RAW_TRIPS.names, ts: str = PICKUP) -> list[Row]:
    """One row per listed file, sorted by path.

    One distributed pass opens all footers. Where a store is out of reach for the tasks'
    Python, Spark infers the schemas of those files one by one, and rows and bounds are unknown.
    """
    tasks = spark.sparkContext.defaultParallelism
    files = listed.dropDuplicates(["path"]).repartition(tasks, "path")
    wanted = {name.lower() for name in names}
    physical: dict[str, str] = {}
    rows = []
    for row in sorted(files.mapInPandas(_reader(names, ts), f"{LISTED}, {FOUND}").collect(), key=lambda row: row.path):
        stored = row.stored
        if stored is None or stored not in physical:
            found = StructType([f for f in spark.read.parquet(row.path).schema if f.name.lower() in wanted])
            if stored is None:
                stored = "\n".join(sorted(f"{f.name.lower()} {f.dataType.simpleString()}" for f in found))
            physical[stored] = found.json()
        rows.append(Row(**{**row.asDict(), "stored": stored, "physical": physical[stored]}))
    return rows


def compare_footers(spark: SparkSession, pattern: str, folder: str) -> tuple[list[Row], list[Row]]:
    """The rows of all files behind ``pattern``, from the table in ``folder`` as far as it knows them, and what differs:
    the rows of new files, and those that the table has of files that are gone or changed.

    Only the footers of new and changed files are opened. The table stays as it is.
    """
    listed = listed_files(spark, pattern)
    whole = storage.complete(spark, folder, "_SUCCESS")
    known = spark.read.schema(FOOTERS).parquet(f"{folder}/v={whole[-1]}").collect() if whole else []
    now = {tuple(row) for row in listed.collect()}
    still = [row for row in known if (row.path, row.length, row.modified) in now]
    there = {(row.path, row.length, row.modified) for row in known}
    new = [row for row in sorted(now) if row not in there]
    opened = read_footers(spark, spark.createDataFrame(new, LISTED)) if new else []
    gone = [row for row in known if (row.path, row.length, row.modified) not in now]
    return sorted([*still, *opened], key=lambda row: row.path), [*opened, *gone]


def store_footers(spark: SparkSession, rows: Sequence[Row], folder: str) -> None:
    """Write a new table beside the old one; it takes its place when it is whole."""
    old = storage.complete(spark, folder, "_SUCCESS")
    columns = [field.split()[0] for field in FOOTERS.split(", ")]
    values = [tuple(row[c] for c in columns) for row in rows]
    spark.createDataFrame(values, FOOTERS).coalesce(1).write.parquet(f"{folder}/v={storage.next_number(spark, folder)}")
    for number in old:
        storage.delete(spark, f"{folder}/v={number}")


def refresh_footers(spark: SparkSession, pattern: str, folder: str) -> list[Row]:
    """The rows of all files behind ``pattern``; the table in ``folder`` knows them afterwards."""
    rows, changed = compare_footers(spark, pattern, folder)
    if changed:
        store_footers(spark, rows, folder)
    return rows
