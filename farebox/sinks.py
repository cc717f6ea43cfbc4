"""Views, tables and partitioned Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

PICKUP_MONTH = ("pickup_year", "pickup_month")

# Trips that one bucket holds, about, and the number of buckets: Spark allows no more than the latter bound.
BUCKET_ROWS = 500_000
MIN_BUCKETS, MAX_BUCKETS = 8, 100_000


def publish_view(df: DataFrame, name: str) -> None:
    """Make a relation queryable by name; it is recomputed at each use."""
    df.createOrReplaceTempView(name)


def save_table(df: DataFrame, name: str) -> None:
    """Replace a catalog table."""
    df.write.mode("overwrite").saveAsTable(name)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a Parquet dataset, partitioned by the given columns if any."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def cluster(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str] = ()) -> DataFrame:
    """Lay rows out for a partitioned write: files per partition value follow its size, not the tasks.

    Rebalancing splits a partition value that holds much of the data and merges
    small ones. With ``sort_by``, row groups have narrow minima and maxima to
    skip by. This shuffles the rows once.
    """
    even = df.hint("rebalance", *partition_by)
    return even.sortWithinPartitions(*partition_by, *sort_by) if sort_by else even


def write_monthly(daily: DataFrame, path: str) -> None:
    """Write daily aggregates as one file per year and month.

    Only for relations with few rows per month: all rows of a month meet in one task.
    """
    write_parquet(daily.repartition(*PICKUP_MONTH), path, PICKUP_MONTH)


def replace_monthly(daily: DataFrame, path: str) -> None:
    """Replace the months that ``daily`` has rows of, and leave the others as they are."""
    writer = daily.repartition(*PICKUP_MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*PICKUP_MONTH).parquet(path)


def bucket_number(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """Buckets for a table of so many rows: a bucket's size stays the same, however large the table."""
    return min(max(-(-rows // bucket_rows), MIN_BUCKETS), MAX_BUCKETS)


def save_by_zone_day(trips: DataFrame, name: str, buckets: int, path: str | None = None) -> None:
    """Replace a catalog table of trips bucketed by pickup zone and date, in order of the pickup.

    Windows and counts per zone and day then need no shuffle, at any number of reads. A bucket
    is one task of a read, so ``buckets`` sets its size, and must follow that of the table
    (``bucket_number``). Trips of one zone and day share a bucket.
    """
    dated = trips.withColumn("trip_date", F.to_date("pickup_datetime"))
    keys = ["pickup_zone", "trip_date"]
    # Dealt by bucket, so a bucket is one file; rebalancing gives a task several small ones, or a part of one with a hot zone and day.
    writer = dated.hint("rebalance", buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys, "pickup_datetime")
    (writer.option("path", path) if path else writer).saveAsTable(name)
