"""Valid trips, and trips with the names of their zones."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from farebox.functions.time import calendar_parts, elapsed_minutes, elapsed_seconds
from farebox.schemas import ENRICHED, position_columns

MIN_MINUTES, MAX_MINUTES = 1, 180
ROLES = ("pickup", "dropoff")

# A zone table is broadcast only up to both of these; beyond them the join shuffles.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
# Trips of one id that one salt holds, about, and ids that can have salts. An id that is not
# among so many more frequent ones holds no more than a 100,000th of all trips.
SALT_ROWS = 1_000_000
HOT_IDS = 100_000


def _valid(measure: Column, low: int, high: int) -> Column:
    """The validity rule. A NULL in any of the four columns drops the row.

    ``measure`` is tested as a distance from the middle of the range: ``between``
    would repeat its time arithmetic once per bound in the generated code.
    """
    return (
        (F.col("trip_distance") > 0)
        & (F.col("fare_amount") > 0)
        & (F.col("passenger_count") > 0)
        & (F.abs(measure * 2 - (low + high)) <= high - low)
    )


def valid_trips(staged: DataFrame) -> DataFrame:
    """Staged trips with positive distance, fare and passengers, of 1 to 180 boundary minutes."""
    return staged.where(_valid(F.col("trip_duration_minutes"), MIN_MINUTES, MAX_MINUTES))


def valid_trips_elapsed(trips: DataFrame) -> DataFrame:
    """The same rule on elapsed minutes, which keeps different trips; tested in whole seconds."""
    seconds = elapsed_seconds("pickup_datetime", "dropoff_datetime")
    return trips.where(_valid(seconds, MIN_MINUTES * 60, MAX_MINUTES * 60)).withColumn(
        "trip_duration_minutes", elapsed_minutes("pickup_datetime", "dropoff_datetime")
    )


@dataclass(frozen=True)
class ZoneDimension:
    """Staged zones, with the facts that decide how they may be joined."""

    zones: DataFrame
    rows: int
    size: int
    unique: bool

    @property
    def broadcastable(self) -> bool:
        return self.rows <= BROADCAST_ROWS and self.size <= BROADCAST_BYTES


def measure_zones(zones: DataFrame) -> ZoneDimension:
    """Measure staged zones in one job: rows, bytes, and whether ids are unique.

    Ids are checked because a repeated one multiplies trips in the joins. Only
    where none repeats may a report leave out a join it takes no column from.
    """
    text = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in ("borough", "zone", "service_zone")), F.lit(0))
    per_id = zones.groupBy("location_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(text.cast("bigint") + 64).alias("size")
    )
    found = per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("size"),
        F.coalesce(F.max(F.when(F.col("location_id").isNotNull(), F.col("n"))), F.lit(0)).alias("most"),
    ).first()
    return ZoneDimension(zones, found["rows"], found["size"], found["most"] <= 1)


def _name_role(trips: DataFrame, dimension: ZoneDimension, role: str, salts: DataFrame | None) -> DataFrame:
    """Left join of the zones on one location column; unmatched trips get NULL names."""
    key = f"{role}_location_id"
    names = dimension.zones.select(
        F.col("location_id").alias("_id"),
        F.col("borough").alias(f"{role}_borough"),
        F.col("zone").alias(f"{role}_zone"),
    )
    if salts is None:
        names = F.broadcast(names) if dimension.broadcastable else names
        return trips.join(names, F.col(key) == F.col("_id"), "left").drop("_id")
    return _salted_left_join(trips, key, names, salts.where(F.col("_role") == role).drop("_role"))


def measure_salts(trips: DataFrame, roles: Sequence[str], salt_rows: int | None = None) -> DataFrame:
    """(_role, _hot, _salts): over how many salts the frequent ids of each role, and NULL, are spread.

    One pass over the id columns counts all roles. The ``HOT_IDS`` most frequent ids of
    each role with more than one salt's rows come to the driver, a list of fixed
    bound, so the joins need no second look at the trips. An id beyond that list is no
    hot one: so many others are more frequent that it has at most their share.
    """
    salt_rows = salt_rows or SALT_ROWS
    ids = F.array(*[F.struct(F.lit(role).alias("_role"), F.col(f"{role}_location_id").alias("_hot")) for role in roles])
    counts = trips.select(F.inline(ids)).groupBy("_role", "_hot").agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy("_role").orderBy(F.desc("_n"), "_hot")
    hot = counts.where(F.col("_n") > salt_rows).withColumn("_rank", F.row_number().over(order))
    hot = hot.where(F.col("_rank") <= HOT_IDS + 1).select("_role", "_hot", F.ceil(F.col("_n") / salt_rows).cast("int").alias("_salts"))
    return trips.sparkSession.createDataFrame(hot.collect(), hot.schema)


def _salted_left_join(trips: DataFrame, key: str, names: DataFrame, salts: DataFrame) -> DataFrame:
    """Shuffled left join that spreads frequent ids, and NULL, over their salts.

    Salts decide only where rows go: no other zone is copied, and an id has as many
    salts as its trips need.
    """
    # The salt depends on values only, so a repeated task repeats it. The position
    # in the source file differs even between equal trips.
    spread = F.xxhash64(*(position_columns(trips) or trips.columns))
    salted = trips.join(F.broadcast(salts), F.col(key).eqNullSafe(F.col("_hot")), "left")
    salted = salted.withColumn("_salt", F.coalesce(F.pmod(spread, "_salts"), F.lit(0)).cast("int")).drop("_hot", "_salts")
    copies = names.where(F.col("_id").isNotNull()).join(F.broadcast(salts), F.col("_id") == F.col("_hot"), "left")
    every = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    copies = copies.withColumn("_copy", F.explode(every)).drop("_hot", "_salts")
    matches = (F.col(key) == F.col("_id")) & (F.col("_salt") == F.col("_copy"))
    return salted.join(copies, matches, "left").drop("_id", "_copy", "_salt")


def name_zones(
    trips: DataFrame, dimension: ZoneDimension, roles: Sequence[str] = ROLES, spread: bool = True
) -> DataFrame:
    """Attach zone and borough names for the given roles.

    A dimension measured as small is broadcast, so trips are not shuffled. A larger
    one is shuffled on id and salt, which splits a location that holds a large
    part of the trips, and the NULL location. Rows that were summed per location
    need no salts: ``spread`` says so.
    """
    salts = measure_salts(trips, roles) if spread and not dimension.broadcastable else None
    for role in roles:
        trips = _name_role(trips, dimension, role, salts)
    return trips


def with_calendar(trips: DataFrame) -> DataFrame:
    """Add year, month and hour of the pickup."""
    return trips.select("*", *calendar_parts("pickup_datetime"))


def enrich(staged: DataFrame, dimension: ZoneDimension) -> DataFrame:
    """Valid trips with calendar parts and the place names of both ends.

    Validity is tested before the joins; no condition reads a zone column.
    """
    named = name_zones(with_calendar(valid_trips(staged)), dimension)
    return named.select(*ENRICHED.names, *position_columns(staged))
