from dataclasses import replace

import pytest

from farebox.jobs import daily
from farebox.operators import enrich
from farebox.plans import marts
from farebox.plans.pipeline import PipelineConfig, QualityError, run_for_date
from farebox.schemas import FACT
from farebox.sources import MissingSource
from tests.conftest import plan_of, rows, trip


@pytest.fixture
def sources(make_trips, tmp_path):
    """Two months of trips and the zone file; returns the configuration of a run."""
    for month, ids in (("01", range(30)), ("02", range(20))):
        raw = make_trips(
            *[
                trip(
                    f"2023-{month}-{1 + i % 5:02d} {i % 24:02d}:10:00",
                    f"2023-{month}-{1 + i % 5:02d} {i % 24:02d}:40:00",
                    PULocationID=1 + i % 6,
                    passenger_count=float(i % 4),
                )
                for i in ids
            ]
        )
        raw.repartition(2).write.parquet(str(tmp_path / "in" / f"yellow_tripdata_2023-{month}.parquet"))
    zones = tmp_path / "zones.csv"
    lines = ["LocationID,Borough,Zone,service_zone", "1,N,Harbor,A", "2,N,Market,A", "3,S,Market,B", "4,N/A,Outside,N/A"]
    zones.write_text("\r\n".join(lines) + "\r\n")
    return PipelineConfig(str(tmp_path / "in"), str(zones), str(tmp_path / "out"))


def contents(spark):
    return {
        "facts": sorted(rows(spark.table("fct_trips").drop("trip_id")), key=str),
        "ids": sorted(r[0] for r in rows(spark.table("fct_trips").select("trip_id"))),
        "dim": sorted(rows(spark.table("dim_zones"))),
        "daily": rows(spark.table("agg_daily_revenue").orderBy("trip_date")),
        "zones": sorted(rows(spark.table("agg_zone_performance")), key=str),
    }


def test_a_run_builds_everything_and_can_be_repeated(spark, sources):
    first = run_for_date(spark, sources, "2023-01-02")
    before = contents(spark)
    assert before["ids"] == list(range(1, 38))
    assert all(line.passed for line in first.report) and len(first.report) == 9
    assert sum(r[1] for r in before["daily"]) == len(before["ids"]) == sum(r[4] for r in before["zones"])
    day = [r for r in before["daily"] if str(r[0]) == "2023-01-02"][0]
    assert tuple(first.summary) == (day[1], day[2])
    assert spark.table("fct_trips").columns == FACT.names

    second = run_for_date(spark, sources, "2023-01-02")
    assert contents(spark) == before
    assert second.summary == first.summary
    # Users' SQL reads the relations by name, and a range prunes month folders.
    for view in ("stg_yellow_trips", "stg_taxi_zones", "int_trips_enriched"):
        assert spark.table(view).count() > 0
    month = spark.sql("SELECT count(*) AS n FROM fct_trips WHERE pickup_year = 2023 AND pickup_month = 2")
    assert "PartitionFilters: [isnotnull(pickup_year" in plan_of(month)


def test_a_clustered_run_from_the_command_line_gives_the_same_relations(spark, sources, tmp_path, capsys):
    summary = run_for_date(spark, sources, "2023-02-01").summary
    plain = contents(spark)
    places = ["--trips-dir", sources.trips_dir, "--zones-csv", sources.zones_csv, "--output-dir", str(tmp_path / "out2")]
    daily.main(["--run-date", "2023-02-01", "--clustered", *places])
    assert contents(spark) == plain
    assert f"trips {summary.total_trips}  revenue {summary.total_revenue}" in capsys.readouterr().out


def test_a_large_dimension_reaches_the_ranks_in_buckets(spark, sources, monkeypatch):
    run_for_date(spark, sources, "2023-01-02")
    before = contents(spark)
    seen = []
    monkeypatch.setattr(enrich, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(enrich, "SALT_ROWS", 5)
    real = marts.rank_descending
    monkeypatch.setattr(marts, "rank_descending", lambda *a: seen.append(a[4]) or real(*a))
    run_for_date(spark, replace(sources, output_dir=f"{sources.output_dir}2"), "2023-01-02")
    assert False in seen and contents(spark) == before


def test_files_follow_months_and_not_tasks(spark, sources, make_trips):
    mixed = [trip(f"2023-{1 + i % 2:02d}-{1 + i % 20:02d} 10:00:00", f"2023-{1 + i % 2:02d}-{1 + i % 20:02d} 10:30:00") for i in range(400)]
    make_trips(*mixed).repartition(16).write.mode("overwrite").parquet(f"{sources.trips_dir}/yellow_tripdata_2023-01.parquet")
    run_for_date(spark, sources, "2023-01-02")
    # one file per month of the source and of the pickup: January's has trips of both
    assert len(spark.table("fct_trips").inputFiles()) == 3
    assert len(spark.table("int_trips_enriched").inputFiles()) == 3


def test_a_month_without_a_file_stops_the_run(spark, sources):
    with pytest.raises(MissingSource, match="2023-03"):
        run_for_date(spark, sources, "2023-03-01")


def test_a_failing_check_stops_the_run_before_the_summary(spark, sources, make_trips):
    raw = make_trips(trip("2023-03-01 10:00:00", "2023-03-01 10:30:00", total_amount=1.0))
    raw.write.parquet(f"{sources.trips_dir}/yellow_tripdata_2023-03.parquet")
    with pytest.raises(QualityError, match="total_ge_fare: 1"):
        run_for_date(spark, sources, "2023-03-01")
    lenient = run_for_date(spark, sources, "2023-03-01", strict=False)
    assert tuple(lenient.summary) == (1, 1.0)
