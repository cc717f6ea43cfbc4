"""Declared schemas of the inputs and of the materialized relations."""

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _struct(fields: Iterable[tuple]) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields])


RAW_TRIPS = _struct(
    [
        ("VendorID", LongType()),
        ("passenger_count", DoubleType()),
        ("tpep_pickup_datetime", TimestampNTZType()),
        ("tpep_dropoff_datetime", TimestampNTZType()),
        ("PULocationID", LongType()),
        ("DOLocationID", LongType()),
        ("trip_distance", DoubleType()),
        ("fare_amount", DoubleType()),
        ("extra", DoubleType()),
        ("mta_tax", DoubleType()),
        ("tip_amount", DoubleType()),
        ("tolls_amount", DoubleType()),
        ("improvement_surcharge", DoubleType()),
        ("total_amount", DoubleType()),
        ("payment_type", LongType()),
    ]
)

RAW_ZONES = _struct(
    [
        ("LocationID", LongType()),
        ("Borough", StringType()),
        ("Zone", StringType()),
        ("service_zone", StringType()),
    ]
)

ENRICHED = _struct(
    [
        ("vendor_id", LongType()),
        ("pickup_datetime", TimestampNTZType()),
        ("dropoff_datetime", TimestampNTZType()),
        ("pickup_year", IntegerType()),
        ("pickup_month", IntegerType()),
        ("pickup_hour", IntegerType()),
        ("passenger_count", DoubleType()),
        ("trip_distance", DoubleType()),
        ("trip_duration_minutes", LongType()),
        ("fare_amount", DoubleType()),
        ("tip_amount", DoubleType()),
        ("total_amount", DoubleType()),
        ("pickup_location_id", LongType()),
        ("pickup_borough", StringType()),
        ("pickup_zone", StringType()),
        ("dropoff_location_id", LongType()),
        ("dropoff_borough", StringType()),
        ("dropoff_zone", StringType()),
    ]
)

# The fact carries tip_amount, which the hour-of-day report reads.
FACT = StructType([StructField("trip_id", LongType()), *ENRICHED.fields])

# Where a trip lies in its source file: hash of the file's path, row in the file.
# The pair is the same in every run over the same files, whatever the splits.
POSITION = ("source_file", "source_row")
# The month in the name of the file that a trip comes from, where a reader was asked for it.
SOURCE_MONTH = "source_month"
PICKUP = "tpep_pickup_datetime"


def position_columns(df: DataFrame) -> list[str]:
    """The position columns ``df`` carries, if it carries both, and the month of the source file."""
    found = list(POSITION) if set(POSITION) <= set(df.columns) else []
    return [*found, SOURCE_MONTH] if SOURCE_MONTH in df.columns else found


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the columns of ``schema`` by name (any case), cast to its types.

    Columns the schema does not name are dropped, position columns are kept, and
    a missing column is an error.
    """
    present = {name.lower(): name for name in df.columns}
    missing = [field.name for field in schema if field.name.lower() not in present]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df.select(
        *[F.col(present[f.name.lower()]).cast(f.dataType).alias(f.name) for f in schema],
        *position_columns(df),
    )
