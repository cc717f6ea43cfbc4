"""Largest gap between consecutive trips of a zone and day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from farebox.functions.time import minute_number


def minute_runs(trips: DataFrame, zone: str = "pickup_zone") -> DataFrame:
    """Trips counted per (zone, pickup minute, dropoff minute), with the last pickup.

    Gaps are counted in minute boundaries, so trips of a zone that share both
    minutes differ only in their order. Counting them first bounds what one zone
    and day can hold by the minutes of a day, however many trips it has.

    Trips that carry their ``trip_date`` are also counted by it: where a table is bucketed by
    zone and date, neither this nor ``max_gaps`` moves them.
    """
    date = ["trip_date"] if "trip_date" in trips.columns else []
    keyed = trips.select(
        zone,
        *date,
        minute_number("pickup_datetime").alias("pickup_minute"),
        minute_number("dropoff_datetime").alias("dropoff_minute"),
        "pickup_datetime",
    )
    return keyed.groupBy(zone, *date, "pickup_minute", "dropoff_minute").agg(
        F.count(F.lit(1)).alias("trips"), F.max("pickup_datetime").alias("last_pickup")
    )


def merge_runs(runs: DataFrame) -> DataFrame:
    """Runs of several ids that share a zone name, added up."""
    return runs.groupBy("pickup_zone", "pickup_minute", "dropoff_minute").agg(
        F.sum("trips").alias("trips"), F.max("last_pickup").alias("last_pickup")
    )


def max_gaps(runs: DataFrame) -> DataFrame:
    """Per (date, zone), the largest gap from a trip's previous dropoff to its pickup.

    The previous trip is the one before it by pickup (then dropoff) among trips
    of its zone and date. In that order every trip of a run but the run's last is
    followed by a pickup in its own minute, and the run's last is followed by the
    next run. So the gaps of a run are its own minute less its dropoff minute, if
    it has two trips or more, and the next run's minute less its dropoff minute.
    Zone and date pairs with a single trip have no gap and no row.
    """
    dated = runs if "trip_date" in runs.columns else runs.withColumn("trip_date", F.to_date("last_pickup"))
    # The hash leads the sort order: most comparisons end at its eight bytes.
    keyed = dated.withColumn("_group", F.xxhash64("trip_date", "pickup_zone"))
    sequence = Window.partitionBy("_group", "trip_date", "pickup_zone").orderBy("last_pickup", "dropoff_minute")
    gaps = keyed.withColumn("previous_dropoff_minute", F.lag("dropoff_minute").over(sequence))
    inside = F.when(F.col("trips") > 1, F.col("pickup_minute") - F.col("dropoff_minute"))
    from_previous = F.col("pickup_minute") - F.col("previous_dropoff_minute")
    return (
        gaps.groupBy("_group", "trip_date", "pickup_zone")
        .agg(F.max(F.greatest(inside, from_previous)).alias("max_gap_minutes"))
        .where(F.col("max_gap_minutes").isNotNull())
        .drop("_group")
    )
