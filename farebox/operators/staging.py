"""Standard names for raw trips and zones."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from farebox.functions.time import boundary_minutes
from farebox.schemas import position_columns

# Raw column, staged column, in output order.
TRIP_COLUMNS = (
    ("VendorID", "vendor_id"),
    ("passenger_count", "passenger_count"),
    ("tpep_pickup_datetime", "pickup_datetime"),
    ("tpep_dropoff_datetime", "dropoff_datetime"),
    ("PULocationID", "pickup_location_id"),
    ("DOLocationID", "dropoff_location_id"),
    ("trip_distance", "trip_distance"),
    ("fare_amount", "fare_amount"),
    ("extra", "extra"),
    ("mta_tax", "mta_tax"),
    ("tip_amount", "tip_amount"),
    ("tolls_amount", "tolls_amount"),
    ("improvement_surcharge", "improvement_surcharge"),
    ("total_amount", "total_amount"),
    ("payment_type", "payment_type"),
)
ZONE_COLUMNS = (
    ("LocationID", "location_id"),
    ("Borough", "borough"),
    ("Zone", "zone"),
    ("service_zone", "service_zone"),
)


def stage_trips(raw: DataFrame) -> DataFrame:
    """Trips that have a pickup time, renamed, with their duration in boundary minutes."""
    duration = boundary_minutes("tpep_pickup_datetime", "tpep_dropoff_datetime")
    return raw.where(F.col("tpep_pickup_datetime").isNotNull()).select(
        *[F.col(name).alias(alias) for name, alias in TRIP_COLUMNS],
        duration.alias("trip_duration_minutes"),
        *position_columns(raw),
    )


def stage_zones(raw: DataFrame) -> DataFrame:
    """Zones, renamed."""
    return raw.select(*[F.col(name).alias(alias) for name, alias in ZONE_COLUMNS])
