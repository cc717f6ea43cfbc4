import random

import pytest
from pyspark.sql import functions as F

from farebox.operators import numbering
from farebox.operators.enrich import enrich, measure_zones, valid_trips
from farebox.operators.numbering import number_rows, read_numbered
from farebox.operators.staging import stage_trips, stage_zones
from farebox.plans.marts import trip_facts
from farebox.schemas import ENRICHED, FACT, POSITION
from farebox.sources import read_trips
from tests.conftest import plan_of, rows


def positioned(spark, files):
    """Rows of several files; ``files`` maps a file number to its row numbers."""
    values = [(f, r, f * 1000 + r) for f, found in files.items() for r in found]
    return spark.createDataFrame(values, f"{POSITION[0]} bigint, {POSITION[1]} bigint, x bigint").repartition(3)


@pytest.mark.parametrize("block_rows", [1, 3, 1 << 20])
def test_ids_follow_the_source_order(spark, block_rows):
    files = {5: range(0, 20, 3), -9: [4, 5, 17], 2: [0], 8: []}
    out = number_rows(positioned(spark, files), "id", block_rows=block_rows)
    assert out.columns == ["id", "x"]
    expected = [f * 1000 + r for f in sorted(files) for r in files[f]]
    assert [x for _, x in sorted(rows(out))] == expected
    assert sorted(i for i, _ in rows(out)) == list(range(1, len(expected) + 1))


def test_repeated_positions_still_get_distinct_ids(spark):
    df = positioned(spark, {1: [0, 0, 0, 1, 1, 2]})
    assert sorted(r[0] for r in rows(number_rows(df, "id", block_rows=2))) == [1, 2, 3, 4, 5, 6]


@pytest.mark.parametrize("seed", [1, 2])
def test_bitmaps_give_the_same_ids_and_leave_the_rows_where_they_are(spark, seed, conf):
    rng = random.Random(seed)
    edges = [0, 1, 62, 63, 64, 65, 4095, 4096, 4097, 8191, 100_000, 2**31, 2**40 + 63]
    files = {5: sorted(rng.sample(range(9000), 700)), -9: edges, 2: [0], 7: range(4096 * 2)}
    df = positioned(spark, files)
    out = number_rows(df, "id", source_rows=2**20)
    assert out.columns == ["id", "x"]
    assert sorted(rows(out)) == sorted(rows(number_rows(df, "id")))
    plan = plan_of(number_rows(df, "id", source_rows=2**20))
    final = plan[: plan.index("BroadcastExchange")] if "BroadcastExchange" in plan else plan
    assert "BroadcastHashJoin" in final and "Window" not in final
    assert rows(number_rows(df.where("x < -1e9"), "id", source_rows=100)) == []
    # too many rows for the bound of the broadcast
    assert "row_number" in plan_of(number_rows(df, "id", source_rows=2**40))


def test_no_rows(spark):
    assert rows(number_rows(positioned(spark, {1: [1]}).where("x < 0"), "id")) == []


def test_written_rows_get_dense_ids_without_a_shuffle(spark, tmp_path, conf, monkeypatch):
    path = str(tmp_path / "t")
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("part"), F.lit("same").alias("text"))
    df.repartition(7).write.partitionBy("part").parquet(path)
    schema = spark.read.parquet(path).select("id", "text", "part").schema
    numbered = read_numbered(spark, path, schema, "row_id")
    assert numbered.columns == ["row_id", "id", "text", "part"]
    plan = plan_of(numbered)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted(r[0] for r in rows(numbered.select("row_id"))) == list(range(1, 1001))
    assert numbered.select("id").distinct().count() == 1000
    # Beyond the bound of the broadcast the ids are the same.
    monkeypatch.setattr(numbering, "BROADCAST_BYTES", 0)
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    shuffled = read_numbered(spark, path, schema, "row_id")
    assert "SortMergeJoin" in plan_of(shuffled)
    assert sorted(rows(shuffled)) == sorted(rows(numbered))
    # Splitting files otherwise changes nothing.
    before = sorted(rows(numbered.select("row_id", "id")))
    conf("spark.sql.files.maxPartitionBytes", "300")
    assert sorted(rows(read_numbered(spark, path, schema, "row_id").select("row_id", "id"))) == before


def test_facts_of_files(spark, make_trips, make_zones, zone_rows, tmp_path):
    raw = make_trips(*[{"VendorID": i, "trip_distance": float(i % 3), "PULocationID": i % 6} for i in range(60)])
    raw.repartition(3).write.parquet(str(tmp_path / "yellow_tripdata_2023-01.parquet"))
    staged = stage_trips(read_trips(spark, str(tmp_path / "*.parquet")))
    enriched = enrich(staged, measure_zones(stage_zones(make_zones(*zone_rows))))
    facts = trip_facts(enriched, valid_trips(staged))
    assert facts.columns == FACT.names
    assert sorted(r[0] for r in rows(facts.select("trip_id"))) == list(range(1, 41))
    assert sorted(rows(facts.drop("trip_id")), key=str) == sorted(rows(enriched.select(*ENRICHED.names)), key=str)
    # Rerunning gives every trip the same id.
    assert sorted(rows(facts), key=str) == sorted(rows(trip_facts(enriched)), key=str)


def test_fact_rows_are_shuffled_once_and_never_into_one_task(spark, conf):
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    df = spark.range(10).selectExpr(f"id % 3 AS {POSITION[0]}", f"id AS {POSITION[1]}", "rand(1) AS payload")
    plan = plan_of(number_rows(df, "trip_id", counted=df.drop("payload")))
    exchanges = [part for part in plan.split("\n\n") if "Exchange" in part.strip().split("\n")[0]]
    of_rows = [part for part in exchanges if "payload" in part]
    assert len(of_rows) == 1 and f"hashpartitioning({POSITION[0]}" in of_rows[0] and "_block" in of_rows[0]
    single = [part for part in exchanges if "SinglePartition" in part]
    assert len(single) == 1 and "_file_n" in single[0]
