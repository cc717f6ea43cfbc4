from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from farebox.operators import enrich as enrichment
from farebox.operators.enrich import enrich, measure_zones, name_zones, valid_trips
from farebox.operators.staging import stage_trips, stage_zones
from farebox.plans.marts import dim_zones
from farebox.schemas import ENRICHED, POSITION
from tests.conftest import plan_of, rows, trip


def test_staging_renames_and_drops_missing_pickups(make_trips):
    staged = stage_trips(make_trips({}, {"tpep_pickup_datetime": None}, {"tpep_dropoff_datetime": None}))
    assert staged.columns[:4] == ["vendor_id", "passenger_count", "pickup_datetime", "dropoff_datetime"]
    assert len(staged.columns) == 16
    assert sorted(r[0] or -1 for r in rows(staged.select("trip_duration_minutes"))) == [-1, 20]


VALIDITY = [
    (trip("2023-01-05 10:00:59", "2023-01-05 10:01:00"), True),
    (trip("2023-01-05 10:00:00", "2023-01-05 10:00:59"), False),
    (trip("2023-01-05 10:00:00", "2023-01-05 13:00:59"), True),
    (trip("2023-01-05 10:00:00", "2023-01-05 13:01:00"), False),
    (trip("2023-01-05 10:00:00", "2023-01-05 09:00:00"), False),
    ({"tpep_dropoff_datetime": None}, False),
    ({"passenger_count": None}, False),
    ({"passenger_count": 0.0}, False),
    ({"trip_distance": 0.0}, False),
    ({"trip_distance": None}, False),
    ({"fare_amount": -1.0}, False),
    ({"fare_amount": None}, False),
    ({"total_amount": None}, True),
    ({"tip_amount": None}, True),
]


def test_validity(make_trips):
    raw = make_trips(*[{**values, "VendorID": i} for i, (values, _) in enumerate(VALIDITY)])
    kept = {r[0] for r in rows(valid_trips(stage_trips(raw)).select("vendor_id"))}
    assert kept == {i for i, (_, valid) in enumerate(VALIDITY) if valid}


def test_unknown_locations_keep_their_trips(make_trips, make_zones, zone_rows):
    raw = make_trips(
        {"PULocationID": 1, "DOLocationID": 99}, {"PULocationID": None, "DOLocationID": 4}, {"PULocationID": 3}
    )
    out = enrich(stage_trips(raw), measure_zones(stage_zones(make_zones(*zone_rows))))
    assert out.columns == ENRICHED.names
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in ENRICHED]
    found = set(rows(out.select("pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone")))
    assert found == {
        ("North", "Harbor", None, None),
        (None, None, "N/A", "Outside"),
        ("South", "Market", "North", "Market"),
    }


def test_repeated_zone_ids_multiply_trips(make_trips, make_zones, zone_rows):
    zones = stage_zones(make_zones(*zone_rows, zone_rows[0], (2, "North", "Other", "Zone A")))
    dimension = measure_zones(zones)
    assert not dimension.unique
    assert enrich(stage_trips(make_trips({"PULocationID": 1, "DOLocationID": 2})), dimension).count() == 4
    # The exact copy goes from the dimension, the other name stays.
    assert dim_zones(zones).count() == 5


def test_measure(make_zones, zone_rows):
    dimension = measure_zones(stage_zones(make_zones(*zone_rows, (None, "a", None, None), (None, "b", "c", "d"))))
    assert (dimension.rows, dimension.unique, dimension.broadcastable) == (6, True, True)
    assert not replace(dimension, size=1 << 40).broadcastable
    assert not replace(dimension, rows=1 << 40).broadcastable
    empty = measure_zones(stage_zones(make_zones(*zone_rows)).limit(0))
    assert (empty.rows, empty.size, empty.unique) == (0, 0, True)


@pytest.mark.parametrize("positions", [True, False])
def test_a_large_dimension_gives_the_same_rows(spark, make_trips, make_zones, zone_rows, conf, positions, monkeypatch):
    """Beyond the bound the join shuffles; a third of the trips are copies at one location."""
    monkeypatch.setattr(enrichment, "SALT_ROWS", 10)
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    base = make_trips(
        *[{"PULocationID": 1, "DOLocationID": 4}] * 40,
        *[{"PULocationID": p, "DOLocationID": d} for p in (1, 2, 3, 4, 99, None) for d in (1, 2, 3, 99, None)],
        *[{"PULocationID": None, "DOLocationID": None}] * 40,
    )
    staged = stage_trips(base)
    if positions:
        staged = staged.withColumn(POSITION[0], F.lit(7).cast("bigint")).withColumn(
            POSITION[1], F.monotonically_increasing_id()
        )
    small = measure_zones(stage_zones(make_zones(*zone_rows, (None, "x", "y", "z"))))
    large = replace(small, rows=1 << 40)
    named = [sorted(rows(enrich(staged, d).select(*ENRICHED.names)), key=str) for d in (small, large)]
    assert named[0] == named[1]
    assert len(named[0]) == 110


@pytest.mark.parametrize("role", ["pickup", "dropoff"])
def test_a_large_dimension_spreads_the_hot_location(spark, make_trips, make_zones, zone_rows, conf, monkeypatch, role):
    monkeypatch.setattr(enrichment, "SALT_ROWS", 20)
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "16")
    staged = (
        stage_trips(make_trips({"PULocationID": 1}))
        .crossJoin(spark.range(3000).withColumnRenamed("id", POSITION[1]))
        .withColumn(POSITION[0], F.lit(7).cast("bigint"))
        .withColumn(f"{role}_location_id", F.expr("if(source_row % 3 = 0, NULL, 1L)"))
    )
    large = replace(measure_zones(stage_zones(make_zones(*zone_rows))), rows=1 << 40)
    parts = name_zones(staged, large, [role]).groupBy(F.spark_partition_id()).count()
    sizes = [r[1] for r in rows(parts)]
    assert sum(sizes) == 3000
    assert len(sizes) == 16 and max(sizes) < 600


def test_both_roles_of_a_large_dimension_scan_the_trips_once(spark, make_trips, make_zones, zone_rows, tmp_path):
    make_trips({"PULocationID": 1, "DOLocationID": 2}).write.parquet(str(tmp_path / "trips"))
    staged = stage_trips(spark.read.parquet(str(tmp_path / "trips")))
    large = replace(measure_zones(stage_zones(make_zones(*zone_rows))), rows=1 << 40)
    assert plan_of(enrich(staged, large)).split("\n(1) ")[0].count("Scan parquet") == 1


def test_every_hot_id_has_salts(spark):
    trips = spark.range(16_000).selectExpr("if(id < 15000, id % 5000, id) AS pickup_location_id", "id % 2 AS dropoff_location_id")
    salts = enrichment.measure_salts(trips, ["pickup", "dropoff"], salt_rows=2)
    found = {(r._role, r._hot): r._salts for r in salts.collect()}
    assert found == {("pickup", i): 2 for i in range(5000)} | {("dropoff", i): 4000 for i in range(2)}
