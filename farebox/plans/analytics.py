"""Analytical reports over the fact, or over valid trips and a zone dimension."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from farebox.functions.money import average, checked_sum, from_units, to_units, total
from farebox.functions.time import half_open, month_start, on_day
from farebox.operators.enrich import ZoneDimension, name_zones
from farebox.operators.gaps import max_gaps, merge_runs, minute_runs
from farebox.operators.zonal import zone_sums

YEAR_START, YEAR_END = date(2023, 1, 1), date(2024, 1, 1)
TOP_ZONES = 10


def _partition_columns(trips: DataFrame) -> dict[str, str]:
    """Year and month columns, where present: a partitioned fact is pruned by them."""
    names = {"year": "pickup_year", "month": "pickup_month"}
    return names if set(names.values()) <= set(trips.columns) else {}


def _within(trips: DataFrame, start: date | datetime | str, end: date | datetime | str) -> DataFrame:
    return trips.where(half_open("pickup_datetime", start, end, **_partition_columns(trips)))


def top_zones_by_month(
    trips: DataFrame,
    dimension: ZoneDimension | None = None,
    start: date | str = YEAR_START,
    end: date | str = YEAR_END,
    top: int = TOP_ZONES,
) -> DataFrame:
    """Pickup zones of the ``top`` revenue ranks of each month, with ties."""
    selected = _within(trips, start, end).withColumn("month", month_start("pickup_datetime"))
    revenue = {"revenue": checked_sum(to_units("total_amount"))}
    monthly = zone_sums(selected, ["pickup_zone"], ["month"], revenue, dimension)
    rank = F.rank().over(Window.partitionBy("month").orderBy(F.desc("revenue")))
    return (
        monthly.withColumn("revenue_rank", rank)
        .where(F.col("revenue_rank") <= top)
        .select(
            "month",
            "pickup_zone",
            from_units(F.col("revenue")).alias("total_revenue"),
            F.col("revenue_rank").cast("bigint").alias("revenue_rank"),
        )
        .orderBy("month", "revenue_rank")
    )


def _tip_share() -> Column:
    """Tip over total per trip: 0 where the total is not positive or NULL, NULL for a NULL tip."""
    return F.when(F.col("total_amount") > 0, F.col("tip_amount") / F.col("total_amount")).otherwise(0.0)


def hour_pattern(trips: DataFrame) -> DataFrame:
    """Demand by hour of day, with a mean over the hour and the two rows before it."""
    hourly = trips.groupBy(F.hour("pickup_datetime").alias("hour_of_day")).agg(
        F.count(F.lit(1)).alias("total_trips"),
        average("fare_amount").alias("avg_fare"),
        F.avg(_tip_share()).alias("avg_tip_pct"),
    )
    # At most 24 rows reach this window.
    recent = Window.orderBy("hour_of_day").rowsBetween(-2, Window.currentRow)
    rolling = F.avg("total_trips").over(recent).alias("rolling_3hr_avg_trips")
    return hourly.select("*", rolling).orderBy("hour_of_day")


def max_gap_by_zone_day(
    trips: DataFrame,
    dimension: ZoneDimension | None = None,
    start: date | str = YEAR_START,
    end: date | str = YEAR_END,
) -> DataFrame:
    """Largest gap in minutes between consecutive trips, per pickup zone and date.

    A dimension that is broadcast names the trips before they are counted; a
    larger one meets the counted runs, which are then added up per name.
    """
    selected = _within(trips, start, end)
    if dimension is None:
        runs = minute_runs(selected)
    elif not dimension.unique:
        runs = minute_runs(name_zones(selected, dimension))
    elif dimension.broadcastable:
        runs = minute_runs(name_zones(selected, dimension, ["pickup"]))
    else:
        per_id = minute_runs(selected, "pickup_location_id")
        runs = merge_runs(name_zones(per_id, dimension, ["pickup"], spread=False))
    # The sort's sample reads the window's shuffle files again; a shuffle of the
    # result rows in between would only spare computing the windows twice.
    return max_gaps(runs).orderBy("trip_date", F.desc("max_gap_minutes"))


def day_summary(trips: DataFrame, day: date | str) -> DataFrame:
    """Trips and revenue of one day; a day without trips gives (0, NULL)."""
    selected = trips.where(on_day("pickup_datetime", day, **_partition_columns(trips)))
    return selected.agg(
        F.count(F.lit(1)).alias("total_trips"), total("total_amount").alias("total_revenue")
    )
