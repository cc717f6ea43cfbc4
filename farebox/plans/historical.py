"""The historical daily KPI: raw files to partitioned Parquet, without zones."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from farebox import storage
from farebox.functions.money import average, total
from farebox.functions.time import calendar_parts, half_open
from farebox.operators.enrich import valid_trips_elapsed
from farebox.schemas import PICKUP
from farebox.sinks import PICKUP_MONTH, replace_monthly, write_monthly
from farebox.sources.footers import compare_footers, store_footers
from farebox.sources.trips import read_trips, scan_trips


def clean(raw: DataFrame) -> DataFrame:
    """Ten raw columns with standard names and types."""
    return raw.select(
        F.col("VendorID").alias("vendor_id"),
        F.col("tpep_pickup_datetime").cast("timestamp_ntz").alias("pickup_datetime"),
        F.col("tpep_dropoff_datetime").cast("timestamp_ntz").alias("dropoff_datetime"),
        *[
            F.col(name).cast("double").alias(name)
            for name in ("passenger_count", "trip_distance", "fare_amount", "tip_amount", "total_amount")
        ],
        F.col("PULocationID").alias("pickup_location_id"),
        F.col("DOLocationID").alias("dropoff_location_id"),
    )


def historical_daily(raw: DataFrame) -> DataFrame:
    """Daily KPI of trips that lasted 1 to 180 elapsed minutes; no revenue gives a NULL tip rate."""
    valid = valid_trips_elapsed(clean(raw))
    dated = valid.select("*", *calendar_parts("pickup_datetime", day=True))
    daily = dated.groupBy("pickup_year", "pickup_month", "pickup_day").agg(
        F.count(F.lit(1)).alias("total_trips"),
        total("fare_amount").alias("total_fare"),
        average("fare_amount").alias("avg_fare"),
        total("tip_amount").alias("total_tips"),
        total("total_amount").alias("total_revenue"),
    )
    return daily.withColumn("tip_rate_percent", F.try_divide("total_tips", "total_revenue") * 100)


def run_historical(spark: SparkSession, pattern: str, path: str) -> None:
    """Rebuild the daily KPI from all trip files behind a glob."""
    write_monthly(historical_daily(read_trips(spark, pattern, positions=False)), path)


def update_historical(spark: SparkSession, pattern: str, path: str) -> list[tuple[int, int]]:
    """Bring the daily KPI up to date after files came, changed or went; returns the months that were replaced.

    The months that a changed file can touch, before and after, show in its footer's first and
    last pickup; a footer that doesn't tell makes all months be replaced. Files that
    cannot hold those months are not read, other months are not written. What has been seen is
    noted last, so a run that fails is repeated by the next one.
    """
    rows, changed = compare_footers(spark, pattern, f"{path}/_footers")
    if not changed:
        return []
    months: set[tuple[int, int]] = set()
    for row in changed:
        if row.bounded and row["first"]:
            span = range(row["first"].year * 12 + row["first"].month - 1, row["last"].year * 12 + row["last"].month)
            months |= {(n // 12, n % 12 + 1) for n in span}
    if not all(row.bounded for row in changed):
        run_historical(spark, pattern, path)
        months = {(r[0], r[1]) for r in spark.read.parquet(path).select(*PICKUP_MONTH).distinct().collect()}
    elif months:
        (year, month), (last_year, last_month) = min(months), max(months)
        between = (datetime(year, month, 1), datetime(last_year + last_month // 12, last_month % 12 + 1, 1))
        trips = scan_trips(spark, rows, positions=False, between=between).where(half_open(PICKUP, *between))
        number = F.year(PICKUP) * 12 + F.month(PICKUP)
        daily = historical_daily(trips.where(number.isin([y * 12 + m for y, m in months])))
        write_monthly(daily, f"{path}/_staged")
        staged = spark.read.schema(daily.schema).parquet(f"{path}/_staged").select(*daily.columns)
        found = {(r[0], r[1]) for r in staged.select(*PICKUP_MONTH).distinct().collect()}
        replace_monthly(staged, path)
        for year, month in months - found:
            storage.delete(spark, f"{path}/pickup_year={year}/pickup_month={month}")
    store_footers(spark, rows, f"{path}/_footers")
    return sorted(months)
