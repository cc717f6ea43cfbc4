"""Fact, dimension and the two KPI aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from farebox.functions.money import checked_sum, from_units, to_units
from farebox.functions.time import calendar_day, calendar_parts
from farebox.operators.enrich import ZoneDimension
from farebox.operators.numbering import number_rows
from farebox.operators.ranking import rank_descending
from farebox.operators.zonal import zone_sums
from farebox.schemas import FACT

HIGH_VOLUME_TRIPS = 10_000
ZONE = ["pickup_zone", "pickup_borough"]
MONTH = ["pickup_year", "pickup_month"]


def trip_facts(enriched: DataFrame, counted: DataFrame | None = None, source_rows: int | None = None) -> DataFrame:
    """Enriched trips with a dense id; they must carry their source positions.

    ``source_rows``, the rows of all source files, may be given if no zone id repeats.
    """
    return number_rows(enriched, "trip_id", counted, source_rows=source_rows).select(*FACT.names)


def dim_zones(zones: DataFrame) -> DataFrame:
    """Distinct staged zones."""
    return zones.select("location_id", "borough", "zone", "service_zone").distinct()


def daily_sums(trips: DataFrame, by: Sequence[str] = (), extra: Sequence[Column] = ()) -> DataFrame:
    """What the daily KPI is made of, by pickup date and ``by``: counts and exact sums, which can be added up."""
    return trips.groupBy(*by, calendar_day("pickup_datetime").alias("trip_date")).agg(
        F.count(F.lit(1)).alias("trips"),
        checked_sum(to_units("total_amount")).alias("revenue"),
        checked_sum(to_units("fare_amount")).alias("fare"),
        F.count("fare_amount").alias("fares"),
        checked_sum(to_units("tip_amount")).alias("tips"),
        *extra,
    )


def daily_report(sums: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The daily KPI from its sums."""
    daily = sums.select(
        *keep,
        "trip_date",
        F.col("trips").alias("total_trips"),
        from_units(F.col("revenue")).alias("total_revenue"),
        F.try_divide(from_units(F.col("fare")), "fares").alias("avg_fare"),
        from_units(F.col("tips")).alias("total_tips"),
    )
    rate = F.when(F.col("total_revenue") > 0, F.col("total_tips") / F.col("total_revenue") * 100).otherwise(0.0)
    return daily.withColumn("tip_rate_percent", rate)


def daily_revenue(trips: DataFrame) -> DataFrame:
    """Daily KPI by pickup date. The tip rate is 0 where revenue is not positive."""
    return daily_report(daily_sums(trips))


def add_up(sums: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Sums of several sources as one row per ``by``; NULL where all are."""
    return sums.groupBy(*by).agg(*[checked_sum(c).alias(c) for c in columns])


DAILY_SUMS = ("trips", "revenue", "fare", "fares", "tips")


def zone_aggregates() -> dict[str, Column]:
    """What the zone KPI is made of, by zone and month: counts and exact sums, which can be added up."""
    return {
        "total_trips": F.count(F.lit(1)),
        "distance": checked_sum(to_units("trip_distance")),
        "distances": F.count("trip_distance"),
        "fare": checked_sum(to_units("fare_amount")),
        "fares": F.count("fare_amount"),
        "revenue": checked_sum(to_units("total_amount")),
    }


def zone_performance(
    trips: DataFrame,
    zones: ZoneDimension,
    high_volume: int = HIGH_VOLUME_TRIPS,
    named: bool = False,
) -> DataFrame:
    """Monthly KPI per pickup zone, with its revenue rank in the month.

    ``named`` states that the trips carry the zone columns already. The dimension is
    needed all the same: a month has one row per zone to rank, so one that is too
    large to broadcast also makes a month too large for one task.
    """
    if "pickup_year" not in trips.columns:
        trips = trips.select("*", *calendar_parts("pickup_datetime"))
    base = zone_sums(trips, ZONE, MONTH, zone_aggregates(), None if named else zones)
    return zone_report(base, zones.broadcastable, high_volume)


def zone_report(sums: DataFrame, bounded: bool, high_volume: int = HIGH_VOLUME_TRIPS) -> DataFrame:
    """The zone KPI from its sums; ``bounded`` states that the zones of a month fit one task."""
    ranked = rank_descending(sums, MONTH, "revenue", "revenue_rank", bounded)
    return ranked.select(
        "pickup_zone",
        "pickup_borough",
        "pickup_year",
        "pickup_month",
        "total_trips",
        F.try_divide(from_units(F.col("distance")), "distances").alias("avg_trip_distance"),
        F.try_divide(from_units(F.col("fare")), "fares").alias("avg_fare"),
        from_units(F.col("revenue")).alias("total_revenue"),
        "revenue_rank",
        (F.col("total_trips") > high_volume).alias("is_high_volume_zone"),
    )
