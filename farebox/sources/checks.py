"""Presence, freshness and a profile of the source."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from farebox.functions.time import calendar_day, second_number
from farebox.schemas import PICKUP, RAW_TRIPS
from farebox.sources.trips import list_files, month_of_file, scan_trips

# Name of a month's trip file, and the declared age limits.
MONTH_FILE = "yellow_tripdata_{month}.parquet"
WARN_AFTER = timedelta(days=1)
ERROR_AFTER = timedelta(days=2)


class MissingSource(FileNotFoundError):
    """The trip file of a month does not exist."""


def _month_of(day: date | str) -> str:
    return str(day)[:7]


def _expected_months(spark: SparkSession, first: date | str, last: date | str) -> DataFrame:
    """Every month from the month of ``first`` to the month of ``last``, as ``yyyy-MM``."""
    bounds = [F.lit(f"{_month_of(day)}-01").cast("date") for day in (first, last)]
    months = F.sequence(*bounds, F.expr("INTERVAL 1 MONTH"))
    return spark.range(1).select(F.explode(months).alias("day")).select(_month_label("day"))


def _month_label(day: Column | str) -> Column:
    return F.date_format(day, "yyyy-MM").alias("month")


def missing_months(trips: DataFrame, ts: str, first: date | str, last: date | str) -> DataFrame:
    """Months from ``first`` to ``last`` in which no trip has its ``ts``."""
    day = calendar_day(ts)
    observed = (
        trips.where(day.isNotNull())
        .groupBy(F.trunc(day, "MM").alias("day"))
        .agg(F.count(F.lit(1)).alias("trips"))
        .select(_month_label("day"))
    )
    expected = _expected_months(trips.sparkSession, first, last)
    return expected.join(observed, "month", "left_anti")


def month_pattern(name: str) -> str:
    """A pattern that finds the month in the path of a file named like ``name``."""
    head, tail = map(re.escape, name.split("{month}"))
    return f"{head}(\\d{{4}}-\\d{{2}}){tail}"


def missing_month_files(
    spark: SparkSession,
    directory: str,
    first: date | str,
    last: date | str,
    name: str = MONTH_FILE,
) -> DataFrame:
    """Months from ``first`` to ``last`` without a trip file. Only lists the directory."""
    listed = list_files(spark, f"{directory}/{name.format(month='*')}")
    observed = listed.select(month_of_file(F.col("path"), month_pattern(name)).alias("month")).distinct()
    return _expected_months(spark, first, last).join(observed, "month", "left_anti")


def require_month_file(
    spark: SparkSession, directory: str, run_date: date | str, name: str = MONTH_FILE
) -> None:
    """Raise if the month of ``run_date`` has no trip file."""
    if not missing_month_files(spark, directory, run_date, run_date, name).isEmpty():
        expected = name.format(month=_month_of(run_date))
        raise MissingSource(f"missing source file: {directory}/{expected}")


def freshness(
    source: DataFrame,
    loaded_at: str,
    now: datetime,
    warn_after: timedelta = WARN_AFTER,
    error_after: timedelta = ERROR_AFTER,
) -> DataFrame:
    """One row: newest load time, its age at ``now`` in seconds, and pass, warn or error.

    ``now`` is in the clock of the column. A source without any load time is an error.
    """
    instant = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    newest = source.agg(F.max(loaded_at).cast("timestamp_ntz").alias("max_loaded_at"))
    age = instant - F.col("max_loaded_at")
    status = (
        F.when(F.col("max_loaded_at").isNull() | (age > F.lit(error_after)), "error")
        .when(age > F.lit(warn_after), "warn")
        .otherwise("pass")
    )
    age_seconds = second_number(instant) - second_number("max_loaded_at")
    return newest.select("max_loaded_at", age_seconds.alias("age_seconds"), status.alias("status"))


def newest_pickup(spark: SparkSession, footers: Sequence[Row]) -> DataFrame:
    """One row, the largest pickup time of some files: from their footers, which need no column.

    Only files whose footers don't tell (no statistics, or a zoned type) are scanned.
    """
    known = spark.createDataFrame([(row["last"],) for row in footers if row.bounded], f"{PICKUP} timestamp_ntz")
    silent = [row for row in footers if not row.bounded]
    if silent:
        known = known.union(scan_trips(spark, silent, StructType([RAW_TRIPS[PICKUP]]), positions=False))
    return known.agg(F.max(PICKUP).alias(PICKUP))


def profile(source: DataFrame, ts: str) -> DataFrame:
    """Row counts of a raw relation: in all, per year and per date of ``ts``.

    ``level`` is ``all``, ``year`` or ``date``. The distinct years and dates are
    the rows of their level (``value`` is NULL where ``ts`` is). One scan: rows
    are counted per date first, and the levels add up those few counts.
    """
    day = calendar_day(ts).alias("day")
    per_day = source.groupBy(day).agg(F.count(F.lit(1)).alias("n"))
    levels = per_day.rollup(F.year("day").alias("year"), "day").agg(
        F.sum("n").alias("row_count"), F.grouping_id().alias("gid")
    )
    level = F.when(F.col("gid") == 3, "all").when(F.col("gid") == 1, "year").otherwise("date")
    value = F.when(F.col("gid") == 0, F.col("day").cast("string")).otherwise(F.col("year").cast("string"))
    return levels.select(level.alias("level"), value.alias("value"), "row_count")


def preview(source: DataFrame, rows: int = 10) -> DataFrame:
    """The first rows of a relation."""
    return source.limit(rows)
