"""Data checks. Each returns the violating rows, so empty means pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows in which ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` that occur more than once, with their number of rows."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def _outside(column: str, low, high) -> Column:
    return (F.col(column) < low) | (F.col(column) > high)


def in_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows in which ``column`` is below ``low`` or above ``high``; NULL is neither."""
    return df.where(_outside(column, low, high))


def total_ge_fare(df: DataFrame) -> DataFrame:
    """Rows in which the total is below the fare."""
    return df.where(F.col("total_amount") < F.col("fare_amount"))


@dataclass(frozen=True)
class Check:
    """One check of one relation: ``not_null``, ``unique``, ``in_range`` or ``total_ge_fare``."""

    relation: str
    kind: str
    column: str
    low: float | None = None
    high: float | None = None

    def violated(self) -> Column:
        """Whether a row violates the check; only for checks that judge single rows."""
        if self.kind == "not_null":
            return F.col(self.column).isNull()
        if self.kind == "in_range":
            return _outside(self.column, self.low, self.high)
        if self.kind == "total_ge_fare":
            return F.col("total_amount") < F.col("fare_amount")
        raise ValueError(f"unknown check {self.kind!r}")


CHECKS = (
    Check("fct_trips", "not_null", "trip_id"),
    Check("fct_trips", "unique", "trip_id"),
    Check("fct_trips", "not_null", "pickup_datetime"),
    Check("fct_trips", "not_null", "total_amount"),
    Check("fct_trips", "not_null", "fare_amount"),
    Check("fct_trips", "in_range", "trip_duration_minutes", 1, 180),
    Check("fct_trips", "total_ge_fare", "total_amount"),
    Check("dim_zones", "not_null", "location_id"),
    Check("dim_zones", "unique", "location_id"),
)


def _failures(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Failures of all checks of a relation in one pass.

    Rows are grouped by the first column that must be unique, carrying the counts of
    the checks on single rows, and the groups are added up. Each further unique
    column takes a pass of its own.
    """
    by_row = [check for check in checks if check.kind != "unique"]
    keys = [check for check in checks if check.kind == "unique"]
    if keys and isinstance(df.schema[keys[0].column].dataType, (ByteType, ShortType, IntegerType, LongType)):
        found = _without_repeats(df, by_row, keys[0])
        if found is not None:
            return _with_other_keys(found, df, keys[1:])
    counts = [F.count_if(check.violated()).alias(f"c{i}") for i, check in enumerate(by_row)]
    if keys:
        repeated = F.count(keys[0].column) > 1
        groups = df.groupBy(F.col(keys[0].column).alias("key")).agg(*counts, repeated.alias("repeated"))
        counts = [F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"c{i}") for i in range(len(by_row))]
        counts.append(F.count_if("repeated").alias(f"c{len(by_row)}"))
        totals = groups.agg(*counts)
    else:
        totals = df.agg(*counts)
    return _with_other_keys(_lines(totals, [*by_row, *keys[:1]]), df, keys[1:])


def _without_repeats(df: DataFrame, by_row: Sequence[Check], key: Check) -> DataFrame | None:
    """The failures if no value of an integer column repeats, else None.

    Values are marked in words of 64 bits, so dense ids shrink 64 times before they are
    shuffled. None repeats if there are as many marks as values.
    """
    value = F.col(key.column).cast("bigint")
    mark = F.expr(f"shiftleft(1L, cast(cast(`{key.column}` as bigint) & 63 as int))")
    counts = [F.count_if(check.violated()).alias(f"c{i}") for i, check in enumerate(by_row)]
    words = df.groupBy(F.shiftright(value, 6).alias("word")).agg(
        *counts, F.count(key.column).alias("values"), F.coalesce(F.bit_count(F.bit_or(mark)), F.lit(0)).alias("marks")
    )
    totals = words.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in words.columns[1:]]).first()
    if totals["values"] != totals["marks"]:
        return None
    row = tuple(totals[f"c{i}"] for i in range(len(by_row)))
    names = [f"c{i} bigint" for i in range(len(by_row) + 1)]
    return _lines(df.sparkSession.createDataFrame([(*row, 0)], ", ".join(names)), [*by_row, key])


def _lines(totals: DataFrame, checks: Sequence[Check]) -> DataFrame:
    return totals.select(F.inline(F.array(*[_line(check, F.col(f"c{i}")) for i, check in enumerate(checks)])))


def _with_other_keys(found: DataFrame, df: DataFrame, keys: Sequence[Check]) -> DataFrame:
    for check in keys:
        other = unique(df, check.column).agg(F.count(F.lit(1)).alias("n")).select(F.inline(F.array(_line(check, F.col("n")))))
        found = found.unionByName(other)
    return found


def _line(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.relation).alias("relation"),
        F.lit(check.kind).alias("check"),
        F.lit(check.column).alias("column"),
        failures.alias("failures"),
    )


def quality_report(relations: Mapping[str, DataFrame], checks: Sequence[Check] = CHECKS) -> DataFrame:
    """One row per check of the given relations: relation, check, column, failures, passed.

    A relation with a unique integer column is read once to mark its values; only if some
    repeat is it read again, to count which.

    A check whose relation is not given, and a relation without a check, is an
    error: either would pass without having been looked at.
    """
    named = {check.relation for check in checks}
    if named - set(relations) or set(relations) - named or not checks:
        raise ValueError(
            f"checks without a relation: {sorted(named - set(relations))}; relations without a check: {sorted(set(relations) - named)}"
        )
    parts = [_failures(df, [check for check in checks if check.relation == name]) for name, df in relations.items()]
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("passed", F.col("failures") == 0)


def violation_counts(checks: Sequence[Check]) -> list[Column]:
    """Aggregates that count, beside others of the same pass, the violations of checks on single rows: ``check_<i>``."""
    return [F.count_if(check.violated()).alias(f"check_{i}") for i, check in enumerate(checks)]


def counted_report(failures: Mapping[Check, int], spark: SparkSession) -> DataFrame:
    """The report of checks whose failures are counted already."""
    rows = [(c.relation, c.kind, c.column, n) for c, n in failures.items()]
    report = spark.createDataFrame(rows, "relation string, check string, column string, failures bigint")
    return report.withColumn("passed", F.col("failures") == 0)
