"""Sums per pickup zone, by location id before the names are joined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from farebox.functions.money import checked_sum
from farebox.operators.enrich import ZoneDimension, name_zones


def zone_sums(
    trips: DataFrame,
    zone_columns: Sequence[str],
    by: Sequence[str],
    sums: dict[str, Column],
    dimension: ZoneDimension | None = None,
) -> DataFrame:
    """Counts and sums per pickup zone and the ``by`` columns.

    Without a dimension the trips carry the zone columns already. With one they
    carry ids: they are summed per id first, so only one row per id meets the
    dimension, whatever its size and however many trips one id holds, and ids
    that share a name are added up after. A dimension with repeated ids
    multiplies trips by the zones at both ends, so it is joined first.
    """
    aggregates = [column.alias(name) for name, column in sums.items()]
    if dimension is None:
        return trips.groupBy(*zone_columns, *by).agg(*aggregates)
    if not dimension.unique:
        return zone_sums(name_zones(trips, dimension), zone_columns, by, sums)
    per_id = trips.groupBy("pickup_location_id", *by).agg(*aggregates)
    named = name_zones(per_id, dimension, ["pickup"], spread=False)
    return named.groupBy(*zone_columns, *by).agg(*[checked_sum(name).alias(name) for name in sums])
