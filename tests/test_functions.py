from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from farebox.functions import (
    average,
    boundary_minutes,
    calendar_parts,
    elapsed_minutes,
    half_open,
    minute_number,
    month_start,
    on_day,
    total,
)
from tests.conftest import at, plan_of, rows


def spans(spark, *pairs):
    values = [(at(a) if a else None, at(b) if b else None) for a, b in pairs]
    return spark.createDataFrame(values, "a timestamp_ntz, b timestamp_ntz")


SPANS = [
    ("2023-01-05 10:00:59", "2023-01-05 10:01:00", 1, 1 / 60),
    ("2023-01-05 10:00:00", "2023-01-05 10:00:59", 0, 59 / 60),
    ("2023-01-05 10:00:00", "2023-01-05 13:00:59", 180, 180 + 59 / 60),
    ("2023-01-05 10:00:00", "2023-01-05 13:01:00", 181, 181.0),
    ("2023-01-05 10:00:00", "2023-01-05 09:59:59", -1, -1 / 60),
    ("2022-12-31 23:59:30", "2023-01-01 00:00:10.900000", 1, 40 / 60),
    ("1969-12-31 23:58:30", "1970-01-01 00:00:00", 2, 1.5),
    ("1969-12-31 23:57:59.500000", "1969-12-31 23:59:59.900000", 2, 2.0),
    (None, "2023-01-05 10:00:00", None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_minutes_do_not_depend_on_the_session_zone(spark, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    df = spans(spark, *[(a, b) for a, b, _, _ in SPANS])
    out = rows(df.select(boundary_minutes("a", "b"), elapsed_minutes("a", "b")))
    assert [r[0] for r in out] == [s[2] for s in SPANS]
    assert [r[1] for r in out] == [pytest.approx(s[3]) if s[3] is not None else None for s in SPANS]


def test_minutes_over_a_clock_change(spark, conf):
    # 02:30 does not exist in this zone on this day; local timestamps do not care.
    conf("spark.sql.session.timeZone", "America/New_York")
    df = spans(spark, ("2023-03-12 01:30:00", "2023-03-12 02:30:00"), ("2023-03-12 01:30:00", "2023-03-12 03:30:00"))
    assert [r[0] for r in rows(df.select(boundary_minutes("a", "b")))] == [60, 120]
    assert [r[0] for r in rows(df.select(elapsed_minutes("a", "b")))] == [60.0, 120.0]


def test_minute_number_counts_from_1970(spark):
    df = spans(spark, ("1970-01-01 00:00:59", None), ("1970-01-02 01:02:03", None), ("1969-12-31 23:59:59", None))
    assert [r[0] for r in rows(df.select(minute_number("a")))] == [0, 1502, -1]


def test_calendar(spark):
    df = spans(spark, ("2023-07-04 23:59:59", None))
    columns = df.select(*calendar_parts("a", day=True), month_start("a").alias("m"))
    assert columns.columns[:4] == ["pickup_year", "pickup_month", "pickup_day", "pickup_hour"]
    assert rows(columns) == [(2023, 7, 4, 23, datetime(2023, 7, 1))]
    assert columns.schema["m"].dataType.simpleString() == "timestamp_ntz"


def test_half_open_bounds(spark):
    df = spans(
        spark,
        ("2022-12-31 23:59:59.999999", None),
        ("2023-01-01 00:00:00", None),
        ("2023-12-31 23:59:59.999999", None),
        ("2024-01-01 00:00:00", None),
        (None, None),
    )
    kept = rows(df.where(half_open("a", date(2023, 1, 1), "2024-01-01")).select("a"))
    assert [r[0] for r in kept] == [datetime(2023, 1, 1), datetime(2023, 12, 31, 23, 59, 59, 999999)]
    assert df.where(on_day("a", "2023-12-31")).count() == 1


def test_range_prunes_partitions_and_reaches_the_scan(spark, tmp_path):
    months = spans(spark, *[(f"{y}-{m:02d}-15 10:00:00", None) for y in (2022, 2023) for m in range(1, 13)])
    path = str(tmp_path / "t")
    months.select("a", *calendar_parts("a")).write.partitionBy("pickup_year", "pickup_month").parquet(path)
    df = spark.read.parquet(path)
    year = df.where(half_open("a", "2023-01-01", "2024-01-01", year="pickup_year", month="pickup_month"))
    assert year.count() == 12
    plan = plan_of(year)
    assert "PartitionFilters: [isnotnull(pickup_year" in plan.replace("\n", "")
    assert "GreaterThanOrEqual(a,2023-01-01T00:00)" in plan
    day = df.where(on_day("a", "2023-05-15", year="pickup_year", month="pickup_month"))
    assert day.inputFiles() and day.count() == 1
    files = day.select(F.input_file_name()).distinct().count()
    assert files == 1


def test_money_is_exact_and_independent_of_order(spark):
    values = [0.1] * 10 + [1e9, -1e9, 0.07]
    for ordered in (values, values[::-1]):
        df = spark.createDataFrame([(v,) for v in ordered], "x double")
        assert rows(df.agg(total("x"), average("x"))) == [(1.07, 1.07 / 13)]


def test_money_skips_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, 2.5), (2, None)], "k int, x double")
    assert sorted(rows(df.groupBy("k").agg(total("x"), average("x")))) == [(1, 2.5, 2.5), (2, None, None)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_never_wrap(spark, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    df = lambda *values: spark.createDataFrame([(v,) for v in values], "x double")
    assert rows(df(6e14, -6e14, 0.1, 0.2, None).select(total("x"), average("x"))) == [(0.3, 0.075)]
    assert rows(df(None).select(total("x"))) == [(None,)]
    for values in ((6e14, 6e14), (float("nan"),), (float("inf"),), (-1e300,)):
        with pytest.raises(Exception, match="out of range"):
            df(*values).select(total("x")).collect()
