"""The zone lookup, a CSV file with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farebox.schemas import RAW_ZONES


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Read the lookup. Header names are checked, and the text ``N/A`` stays text."""
    return spark.read.csv(path, schema=RAW_ZONES, header=True, enforceSchema=False)
