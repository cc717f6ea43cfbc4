"""RANK inside groups that may be too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

BUCKETS = 256


def _join_equal(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on equal keys, where NULL equals NULL."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    return left.join(renamed, [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys]).drop(
        *[f"_right_{key}" for key in keys]
    )


def rank_descending(
    rows: DataFrame, by: Sequence[str], value: str, name: str, bounded: bool = True, buckets: int = BUCKETS
) -> DataFrame:
    """Add the rank, with gaps, of ``value`` in descending order inside each ``by`` group.

    ``bounded`` states that a group fits one task; a window does it then.
    Otherwise the values of a group are cut into ordered buckets, so a rank is
    the rows in higher buckets, plus the rows above it in its own, plus one.
    Cuts are approximate quantiles of the distinct values: they decide how even
    the buckets are, not the ranks. Equal values are counted before they are
    gathered. NULL ranks last.
    """
    if bounded:
        window = Window.partitionBy(*by).orderBy(F.desc(value))
        return rows.withColumn(name, F.rank().over(window).cast("bigint"))

    values = rows.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    shares = [i / buckets for i in range(1, buckets)]
    cuts = values.groupBy(*by).agg(F.percentile_approx(value, shares).alias("_cuts"))
    below = F.size(F.filter("_cuts", lambda cut: cut < F.col(value)))
    placed = _join_equal(values, cuts, by).withColumn("_bucket", F.when(F.col(value).isNull(), -1).otherwise(below))

    rows_before = F.sum("_n").over(
        Window.partitionBy(*by, "_bucket").orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, -1)
    )
    in_higher = F.sum("_bucket_n").over(
        Window.partitionBy(*by).orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    )
    higher = (
        placed.groupBy(*by, "_bucket").agg(F.sum("_n").alias("_bucket_n")).withColumn("_higher", in_higher).drop("_bucket_n")
    )
    rank = F.coalesce("_higher", F.lit(0)) + F.coalesce("_before", F.lit(0)) + 1
    ranks = _join_equal(placed.withColumn("_before", rows_before), higher, [*by, "_bucket"])
    return _join_equal(rows, ranks.select(*by, value, rank.cast("bigint").alias(name)), [*by, value])
