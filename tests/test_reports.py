from dataclasses import replace
from datetime import date, datetime

import pytest

from farebox.operators.enrich import enrich, measure_zones, valid_trips
from farebox.operators.staging import stage_trips, stage_zones
from farebox.plans.analytics import day_summary, hour_pattern, max_gap_by_zone_day, top_zones_by_month
from farebox.plans.historical import historical_daily, run_historical
from farebox.plans.marts import daily_revenue, zone_performance
from tests.conftest import plan_of, rows, trip


@pytest.fixture
def dimension(make_zones, zone_rows):
    return measure_zones(stage_zones(make_zones(*zone_rows)))


def at_hour(hour, day="2023-01-05", **values):
    return trip(f"{day} {hour:02d}:00:00", f"{day} {hour:02d}:20:00", **values)


def test_daily_revenue(make_trips):
    trips = valid_trips(
        stage_trips(
            make_trips(
                at_hour(1, total_amount=14.0, tip_amount=2.0),
                at_hour(2, total_amount=26.0, tip_amount=None, fare_amount=20.0),
                at_hour(3, day="2023-01-06", total_amount=-5.0, tip_amount=1.0),
                at_hour(4, day="2023-01-07", total_amount=None),
            )
        )
    )
    assert rows(daily_revenue(trips).orderBy("trip_date")) == [
        (date(2023, 1, 5), 2, 40.0, 15.0, 2.0, 5.0),
        (date(2023, 1, 6), 1, -5.0, 10.0, 1.0, 0.0),
        (date(2023, 1, 7), 1, None, 10.0, 2.0, 0.0),
    ]


def test_zone_performance(make_trips, dimension):
    staged = stage_trips(
        make_trips(
            at_hour(1, PULocationID=1, total_amount=30.0, trip_distance=1.0),
            at_hour(2, PULocationID=1, total_amount=10.0, trip_distance=2.0),
            at_hour(2, PULocationID=2, total_amount=40.0),
            at_hour(2, PULocationID=99, total_amount=5.0),
            at_hour(2, PULocationID=None, total_amount=6.0),
            at_hour(2, PULocationID=3, total_amount=1.0),
            at_hour(2, PULocationID=3, total_amount=1.0, day="2022-01-05"),
        )
    )
    expected = {
        ("Harbor", "North", 2023, 1, 2, 1.5, 10.0, 40.0, 1, True),
        ("Market", "North", 2023, 1, 1, 2.0, 10.0, 40.0, 1, False),
        (None, None, 2023, 1, 2, 2.0, 10.0, 11.0, 3, True),
        ("Market", "South", 2023, 1, 1, 2.0, 10.0, 1.0, 4, False),
        ("Market", "South", 2022, 1, 1, 2.0, 10.0, 1.0, 1, False),
    }
    assert set(rows(zone_performance(enrich(staged, dimension), dimension, high_volume=1, named=True))) == expected
    assert set(rows(zone_performance(valid_trips(staged), dimension, high_volume=1))) == expected
    large = replace(dimension, rows=1 << 40)
    assert set(rows(zone_performance(valid_trips(staged), large, high_volume=1))) == expected


def test_mean_distance_does_not_depend_on_order(make_trips, dimension):
    distances = [0.1 * (i % 7 + 1) for i in range(50)] + [1e6, 0.3]
    trips = [at_hour(1, PULocationID=1, trip_distance=d) for d in distances]
    out = [
        rows(zone_performance(valid_trips(stage_trips(make_trips(*t))), dimension).select("avg_trip_distance"))
        for t in (trips, trips[::-1])
    ]
    assert out[0] == out[1] == [(sum(round(d * 10_000) for d in distances) / 10_000 / 52,)]


def test_high_volume_is_above_the_threshold(make_trips, spark, dimension):
    staged = stage_trips(make_trips(at_hour(1)))
    for trips, flag in ((10_000, False), (10_001, True)):
        many = staged.crossJoin(spark.range(trips).drop("id"))
        out = rows(zone_performance(valid_trips(many), dimension).select("total_trips", "is_high_volume_zone"))
        assert out == [(trips, flag)]


def test_zone_reports_with_repeated_ids_count_like_the_joined_relation(make_trips, make_zones, zone_rows):
    zones = measure_zones(stage_zones(make_zones(*zone_rows, (1, "North", "Harbor", "x"), (4, "N/A", "Far", "x"))))
    staged = stage_trips(make_trips(at_hour(1, DOLocationID=4), at_hour(4), at_hour(5, PULocationID=4, DOLocationID=1)))
    valid, enriched = valid_trips(staged), enrich(staged, zones)
    over_named = {
        zone_performance: lambda trips: zone_performance(trips, zones, named=True),
        top_zones_by_month: top_zones_by_month,
        max_gap_by_zone_day: max_gap_by_zone_day,
    }
    for report in over_named:
        assert sorted(rows(report(valid, zones)), key=str) == sorted(rows(over_named[report](enriched)), key=str)


def test_top_zones_keep_ties_at_the_last_rank(make_trips, make_zones):
    zones = measure_zones(stage_zones(make_zones(*[(i, "b", f"z{i:02d}", "s") for i in range(15)])))
    totals = [100 - i for i in range(9)] + [50, 50, 50, 49, 48, 47]
    raw = make_trips(*[at_hour(1, PULocationID=i, total_amount=float(v)) for i, v in enumerate(totals)])
    report = top_zones_by_month(valid_trips(stage_trips(raw)), zones)
    assert "WindowGroupLimit" in plan_of(report)
    out = rows(report)
    assert len(out) == 12
    assert [r[3] for r in out] == list(range(1, 10)) + [10, 10, 10]
    assert out[0] == (datetime(2023, 1, 1), "z00", 100.0, 1)
    assert report.schema["month"].dataType.simpleString() == "timestamp_ntz"


def test_top_zones_merge_ids_of_one_name_and_respect_bounds(make_trips, dimension):
    raw = make_trips(
        at_hour(1, PULocationID=2, total_amount=10.0),
        at_hour(1, PULocationID=3, total_amount=10.0),
        at_hour(1, PULocationID=1, total_amount=15.0),
        at_hour(0, day="2023-02-01", PULocationID=1),
        at_hour(0, day="2024-01-01", PULocationID=1),
        at_hour(23, day="2022-12-31", PULocationID=1),
    )
    assert rows(top_zones_by_month(valid_trips(stage_trips(raw)), dimension)) == [
        (datetime(2023, 1, 1), "Market", 20.0, 1),
        (datetime(2023, 1, 1), "Harbor", 15.0, 2),
        (datetime(2023, 2, 1), "Harbor", 14.0, 1),
    ]


def test_hour_pattern(make_trips):
    raw = make_trips(
        at_hour(0, total_amount=10.0, tip_amount=1.0),
        at_hour(0, total_amount=10.0, tip_amount=None),
        at_hour(0, total_amount=None, tip_amount=5.0),
        at_hour(0, total_amount=-1.0, tip_amount=5.0),
        at_hour(5, total_amount=10.0, tip_amount=5.0),
        at_hour(9, fare_amount=20.0, total_amount=20.0, tip_amount=5.0),
        at_hour(9, day="2021-05-05", fare_amount=10.0, total_amount=20.0, tip_amount=None),
        at_hour(23, tip_amount=None),
    )
    out = rows(hour_pattern(valid_trips(stage_trips(raw))))
    assert [r[:3] for r in out] == [(0, 4, 10.0), (5, 1, 10.0), (9, 2, 15.0), (23, 1, 10.0)]
    assert [r[3] for r in out] == [pytest.approx(0.1 / 3), 0.5, 0.25, None]
    assert [r[4] for r in out] == [4.0, 2.5, pytest.approx(7 / 3), pytest.approx(4 / 3)]


def test_day_summary(make_trips):
    trips = valid_trips(stage_trips(make_trips(at_hour(0), at_hour(23), at_hour(0, day="2023-01-06"))))
    assert rows(day_summary(trips, "2023-01-05")) == [(2, 28.0)]
    assert rows(day_summary(trips, date(2023, 1, 7))) == [(0, None)]


HISTORICAL = [
    trip("2023-01-05 10:00:59", "2023-01-05 10:01:00"),  # one second: not here, though it crosses a boundary
    trip("2023-01-05 10:00:00", "2023-01-05 13:00:59"),
    trip("2023-01-05 10:00:00", "2023-01-05 10:01:00", tip_amount=1.0, total_amount=10.0),
    trip("2023-01-05 10:00:00.900000", "2023-01-05 13:00:00.100000", tip_amount=None, total_amount=10.0),
    trip("2023-02-05 10:00:00", "2023-02-05 10:30:00", total_amount=0.0),
    trip("2023-02-06 10:00:00", "2023-02-06 10:30:00", total_amount=-4.0, tip_amount=1.0),
    trip(None, "2023-02-06 10:30:00"),
]
HISTORICAL_DAYS = [
    (2023, 1, 5, 2, 20.0, 10.0, 1.0, 20.0, 5.0),
    (2023, 2, 5, 1, 10.0, 10.0, 2.0, 0.0, None),
    (2023, 2, 6, 1, 10.0, 10.0, 1.0, -4.0, -25.0),
]


def test_historical_daily(make_trips):
    out = historical_daily(make_trips(*HISTORICAL)).orderBy("pickup_year", "pickup_month", "pickup_day")
    assert rows(out) == HISTORICAL_DAYS


def test_historical_run_writes_one_file_per_month(spark, make_trips, tmp_path):
    make_trips(*HISTORICAL).repartition(3).write.parquet(str(tmp_path / "in" / "yellow_tripdata_2023-01.parquet"))
    path = str(tmp_path / "out")
    for _ in range(2):
        run_historical(spark, str(tmp_path / "in" / "*.parquet"), path)
    written = spark.read.parquet(path)
    names = ["pickup_year", "pickup_month", "pickup_day"]
    ordered = written.select(*names, *[c for c in written.columns if c not in names]).orderBy(*names)
    assert rows(ordered) == HISTORICAL_DAYS
    assert sorted(p.name for p in (tmp_path / "out" / "pickup_year=2023").iterdir()) == ["pickup_month=1", "pickup_month=2"]
    assert len(written.inputFiles()) == 2
