from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from farebox.schemas import POSITION, RAW_TRIPS
from farebox.sinks import publish_view, save_table
from farebox.sources import (
    MissingSource,
    freshness,
    ingest,
    missing_month_files,
    missing_months,
    preview,
    profile,
    read_trips,
    read_zones,
    registered_table,
    require_month_file,
)
from tests.conftest import plan_of, rows, trip

TS = "tpep_pickup_datetime"


def write_month(df, directory, month):
    path = str(directory / f"yellow_tripdata_{month}.parquet")
    df.coalesce(1).write.parquet(path)
    return path


@pytest.fixture
def drifting(make_trips, tmp_path):
    """Four months: two physical types of the same column, and other column spellings."""
    one = make_trips({"passenger_count": 1.0}, {"passenger_count": None}).withColumn("airport_fee", F.lit(1.0))
    write_month(one, tmp_path, "2023-01")
    later = one.withColumn("passenger_count", F.col("passenger_count").cast("bigint")).withColumn(
        "VendorID", F.col("VendorID").cast("int")
    )
    write_month(later, tmp_path, "2023-02")
    write_month(later.withColumnRenamed("airport_fee", "Airport_fee"), tmp_path, "2023-03")
    write_month(one.withColumnRenamed("PULocationID", "pulocationid"), tmp_path, "2023-04")
    return tmp_path


def test_files_with_different_types_become_one_relation(spark, drifting):
    trips = read_trips(spark, f"{drifting}/yellow_tripdata_*.parquet", positions=False)
    assert [(f.name, f.dataType) for f in trips.schema] == [(f.name, f.dataType) for f in RAW_TRIPS]
    assert trips.count() == 8
    assert sorted(r[0] or 0 for r in rows(trips.select("passenger_count"))) == [0.0] * 4 + [1.0] * 4
    # Two physical schemas, so two scans, each pruned and filtered.
    plan = plan_of(trips.where("trip_distance > 5").select("trip_distance"))
    assert plan.count("ReadSchema: struct<trip_distance:double>") == 2
    assert plan.count("GreaterThan(trip_distance,5.0)") == 2


def test_positions_are_the_same_in_any_split(spark, drifting, conf):
    pattern = f"{drifting}/yellow_tripdata_*.parquet"
    before = sorted(rows(read_trips(spark, pattern).select(*POSITION)))
    conf("spark.sql.files.maxPartitionBytes", "2000")
    assert sorted(rows(read_trips(spark, pattern).select(*POSITION))) == before
    assert len(set(before)) == 8


def test_missing_column_is_an_error(spark, make_trips, tmp_path):
    write_month(make_trips({}).drop("tip_amount"), tmp_path, "2023-01")
    with pytest.raises(ValueError, match="tip_amount"):
        read_trips(spark, f"{tmp_path}/*.parquet")


def test_one_bad_file_among_good_ones_is_an_error(spark, make_trips, tmp_path):
    good = make_trips({}, {})
    for month in ("2023-01", "2023-02", "2023-04"):
        write_month(good, tmp_path, month)
    write_month(good.drop("passenger_count", "extra"), tmp_path, "2023-03")
    pattern = f"{tmp_path}/*.parquet"
    with pytest.raises(ValueError, match="missing columns \\['passenger_count', 'extra'\\].*2023-03") as error:
        read_trips(spark, pattern)
    assert "2023-02" not in str(error.value)
    with pytest.raises(ValueError, match="passenger_count"):
        read_trips(spark, pattern, optional=["extra"])
    trips = read_trips(spark, pattern, optional=["extra", "passenger_count"], positions=False)
    assert trips.where("extra is null and passenger_count is null").count() == 2 and trips.count() == 8


def test_footers_are_read_in_one_pass_however_types_alternate(spark, make_trips, tmp_path):
    one = make_trips({})
    other = one.withColumn("passenger_count", F.col("passenger_count").cast("bigint"))
    jobs = []
    for files in (2, 8):
        for i in range(files):
            (one if i % 2 else other).coalesce(1).write.parquet(str(tmp_path / f"{files}" / f"{i}.parquet"))
        group = f"footers-{files}"
        spark.sparkContext.setJobGroup(group, group)
        assert read_trips(spark, f"{tmp_path}/{files}/*.parquet").count() == files
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]


def test_no_files_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_trips(spark, f"{tmp_path}/*.parquet")


def test_zones_keep_text_and_drop_line_ends(spark, tmp_path):
    path = tmp_path / "zones.csv"
    lines = ['"LocationID","Borough","Zone","service_zone"', '1,"North","Harbor, Old","A"', '265,"N/A","Outside","N/A"']
    path.write_bytes("\r\n".join(lines + [""]).encode())
    assert rows(read_zones(spark, str(path))) == [(1, "North", "Harbor, Old", "A"), (265, "N/A", "Outside", "N/A")]


def test_zones_header_is_checked(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text("id,Borough,Zone,service_zone\n1,a,b,c\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_zones(spark, str(path)).collect()


def test_ingest_replaces_the_table(spark, drifting):
    spark.sql("CREATE DATABASE IF NOT EXISTS main_raw LOCATION '%s'" % (drifting / "db"))
    pattern = f"{drifting}/yellow_tripdata_*.parquet"
    ingest(spark, pattern, "main_raw.yellow_tripdata")
    ingest(spark, pattern, "main_raw.yellow_tripdata")
    assert registered_table(spark, "main_raw", "yellow_tripdata").count() == 8
    assert "yellow_tripdata" in [t.name for t in spark.catalog.listTables("main_raw")]
    spark.sql("DROP DATABASE main_raw CASCADE")


def test_month_files(spark, drifting):
    missing = rows(missing_month_files(spark, str(drifting), "2022-12-31", "2023-06-01").orderBy("month"))
    assert missing == [("2022-12",), ("2023-05",), ("2023-06",)]
    require_month_file(spark, str(drifting), "2023-04-30")
    with pytest.raises(MissingSource, match="yellow_tripdata_2023-05.parquet"):
        require_month_file(spark, str(drifting), "2023-05-01")


def test_months_without_trips(make_trips):
    trips = make_trips({TS: "2023-01-31 23:59:59"}, {TS: "2023-03-01 00:00:00"}, {TS: None})
    assert rows(missing_months(trips, TS, "2023-01-15", "2023-04-01").orderBy("month")) == [("2023-02",), ("2023-04",)]


@pytest.mark.parametrize(
    "age, status",
    [
        (timedelta(days=1), "pass"),
        (timedelta(days=1, seconds=1), "warn"),
        (timedelta(days=2), "warn"),
        (timedelta(days=2, seconds=1), "error"),
    ],
)
def test_freshness(make_trips, age, status):
    trips = make_trips({TS: "2023-01-05 10:00:00"}, {TS: "2023-01-04 10:00:00"}, {TS: None})
    now = datetime(2023, 1, 5, 10) + age
    assert rows(freshness(trips, TS, now)) == [(datetime(2023, 1, 5, 10), age.total_seconds(), status)]


def test_freshness_without_load_times_is_an_error(make_trips):
    assert rows(freshness(make_trips({TS: None}), TS, datetime(2023, 1, 1))) == [(None, None, "error")]


def test_profile(make_trips):
    trips = make_trips(
        {TS: "2023-01-05 10:00:00"}, {TS: "2023-01-05 11:00:00"}, {TS: "2022-12-31 10:00:00"}, {TS: None}
    )
    found = {(level, value): n for level, value, n in rows(profile(trips, TS))}
    assert found == {
        ("all", None): 4,
        ("year", "2023"): 2,
        ("year", "2022"): 1,
        ("year", None): 1,
        ("date", "2023-01-05"): 2,
        ("date", "2022-12-31"): 1,
        ("date", None): 1,
    }
    assert preview(trips, 2).count() == 2


def test_profile_of_nothing(make_trips):
    assert rows(profile(make_trips({}).limit(0), TS)) == []


def test_views_and_tables(spark, make_trips):
    trips = make_trips({}, {})
    publish_view(trips, "some_trips")
    assert spark.sql("SELECT count(*) FROM some_trips").first()[0] == 2
    for kept in (2, 1):
        save_table(trips.limit(kept), "some_table")
        assert spark.table("some_table").count() == kept
    spark.sql("DROP TABLE some_table")


def test_a_file_behind_two_patterns_is_read_once(make_trips, spark, tmp_path):
    path = write_month(make_trips(trip("2023-01-01 00:00:00", "2023-01-01 00:10:00")), tmp_path, "2023-01")
    assert read_trips(spark, path, f"{tmp_path}/*.parquet").count() == 1
