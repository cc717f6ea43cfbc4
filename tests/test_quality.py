import pytest
from pyspark.sql import functions as F

from farebox.operators.enrich import enrich, measure_zones
from farebox.operators.quality import Check, in_range, not_null, quality_report, total_ge_fare, unique
from farebox.operators.staging import stage_trips, stage_zones
from farebox.schemas import FACT
from tests.conftest import at, rows


def fact_rows(spark, *changes):
    """Fact rows that pass every check, but for the given changes."""
    base = {f.name: None for f in FACT} | {
        "pickup_datetime": at("2023-01-05 10:00:00"),
        "total_amount": 10.0,
        "fare_amount": 8.0,
        "trip_duration_minutes": 20,
    }
    values = [{**base, "trip_id": i, **change} for i, change in enumerate(changes)]
    return spark.createDataFrame([tuple(v[f.name] for f in FACT) for v in values], FACT)


def test_checks_return_the_violating_rows(spark):
    df = spark.createDataFrame(
        [(1, 1, 10.0, 8.0), (2, 180, 8.0, 8.0), (2, 0, 7.0, 8.0), (None, 181, None, 8.0), (None, None, 1.0, None)],
        "id bigint, minutes bigint, total_amount double, fare_amount double",
    )
    assert [r[0] for r in rows(not_null(df, "id"))] == [None, None]
    assert rows(unique(df, "id")) == [(2, 2)]
    assert [r[1] for r in rows(in_range(df, "minutes", 1, 180))] == [0, 181]
    assert [r[2] for r in rows(total_ge_fare(df))] == [7.0]


def test_clean_relations_pass(spark, make_zones, zone_rows):
    zones = stage_zones(make_zones(*zone_rows))
    report = rows(quality_report({"fct_trips": fact_rows(spark, {}, {}), "dim_zones": zones}))
    assert len(report) == 9
    assert all(failures == 0 and passed for _, _, _, failures, passed in report)


def test_each_check_fails_on_its_violation(spark, make_zones, zone_rows):
    facts = fact_rows(
        spark,
        {"trip_id": None},
        {"trip_id": 7},
        {"trip_id": 7},
        {"pickup_datetime": None},
        {"total_amount": None},
        {"fare_amount": None},
        {"trip_duration_minutes": 0},
        {"trip_duration_minutes": 181},
        {"trip_duration_minutes": None},
        {"total_amount": 7.99},
    )
    zones = stage_zones(make_zones(*zone_rows, (1, "x", "y", "z"), (None, "x", "y", "z")))
    report = {(r, c, k): (n, ok) for r, c, k, n, ok in rows(quality_report({"fct_trips": facts, "dim_zones": zones}))}
    assert report == {
        ("fct_trips", "not_null", "trip_id"): (1, False),
        ("fct_trips", "unique", "trip_id"): (1, False),
        ("fct_trips", "not_null", "pickup_datetime"): (1, False),
        ("fct_trips", "not_null", "total_amount"): (1, False),
        ("fct_trips", "not_null", "fare_amount"): (1, False),
        ("fct_trips", "in_range", "trip_duration_minutes"): (2, False),
        ("fct_trips", "total_ge_fare", "total_amount"): (1, False),
        ("dim_zones", "not_null", "location_id"): (1, False),
        ("dim_zones", "unique", "location_id"): (1, False),
    }


def test_own_checks(make_trips, make_zones, zone_rows):
    trips = enrich(stage_trips(make_trips({}, {"PULocationID": 77})), measure_zones(stage_zones(make_zones(*zone_rows))))
    checks = [Check("trips", "not_null", "pickup_zone"), Check("trips", "in_range", "trip_distance", 0.5, 1.5)]
    report = rows(quality_report({"trips": trips.withColumn("x", F.lit(1))}, checks))
    assert [(kind, n) for _, kind, _, n, _ in report] == [("not_null", 1), ("in_range", 2)]


def test_nothing_is_left_out_silently(spark, make_zones, zone_rows):
    facts, zones = fact_rows(spark, {}), stage_zones(make_zones(*zone_rows))
    with pytest.raises(ValueError, match="checks without a relation: \\['fct_trips'\\]"):
        quality_report({"dim_zones": zones})
    with pytest.raises(ValueError, match="relations without a check: \\['fct_trip'\\]"):
        quality_report({"fct_trips": facts, "dim_zones": zones, "fct_trip": facts})
    with pytest.raises(ValueError):
        quality_report({})
    with pytest.raises(ValueError):
        quality_report({"trips": facts}, [])


def test_no_rows_and_two_unique_columns(spark):
    df = spark.createDataFrame([(1, 1, 2.0), (2, 1, None), (None, None, 1.0), (None, 3, 1.0)], "a int, b int, c double")
    checks = [Check("t", "unique", "a"), Check("t", "unique", "b"), Check("t", "not_null", "c")]
    report = {(k, c): n for _, k, c, n, _ in rows(quality_report({"t": df}, checks))}
    assert report == {("unique", "a"): 0, ("unique", "b"): 1, ("not_null", "c"): 1}
    assert [r[3:] for r in rows(quality_report({"t": df.limit(0)}, checks))] == [(0, True)] * 3


@pytest.mark.parametrize("extra, failures", [([], 0), ([5], 1), ([5, 5, 9, -3], 3), ([None, None], 0), ([2**62], 0)])
def test_repeated_integers_are_found_by_marks(spark, extra, failures):
    values = [(v, 1.0) for v in [*range(-200, 3000), 2**62 - 1, *extra]]
    df = spark.createDataFrame(values, "id long, x double").repartition(3)
    checks = [Check("t", "unique", "id"), Check("t", "not_null", "id")]
    found = {r.check: (r.failures, r.passed) for r in quality_report({"t": df}, checks).collect()}
    nulls = extra.count(None)
    assert found == {"unique": (failures, failures == 0), "not_null": (nulls, nulls == 0)}
