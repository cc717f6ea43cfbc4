"""The derived trips as a user has them: month files and a zone CSV, read and written by the real jobs."""

from __future__ import annotations

import re
import tempfile
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from farebox import storage
from farebox.functions.time import half_open
from farebox.operators.staging import stage_trips
from farebox.plans import pipeline
from farebox.plans.analytics import max_gap_by_zone_day
from farebox.plans.historical import run_historical
from farebox.plans.pipeline import PipelineConfig, build_relations
from farebox.schemas import PICKUP
from farebox.sinks import BUCKET_ROWS, bucket_number, save_by_zone_day
from farebox.sources.checks import freshness, newest_pickup
from farebox.sources.footers import refresh_footers
from farebox.sources.trips import ingest, registered_table
from fixtures.adapter import raw_trips, raw_zones

MONTH_FOLDER = "month={month}"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names for shared files; on one machine, and only there, a temporary one will do."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return shared or tempfile.mkdtemp(prefix="farebox-")


def write_sources(spark: SparkSession, sf_dir: str, high_volume: int) -> PipelineConfig:
    """Write trips by pickup month, and zones, to a new folder of the shared checkpoint folder."""
    root = f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"
    trips = raw_trips(spark, sf_dir).withColumn("month", F.date_format("tpep_pickup_datetime", "yyyy-MM"))
    trips.hint("rebalance", "month").write.partitionBy("month").parquet(f"{root}/trips")
    raw_zones(spark, sf_dir).write.csv(f"{root}/zones", header=True)
    return PipelineConfig(f"{root}/trips", f"{root}/zones", f"{root}/out", MONTH_FOLDER, high_volume)


def relation(spark: SparkSession, sf_dir: str, high_volume: int, name: str) -> DataFrame:
    """One relation of the daily run over the files; the fact's ids depend on the files and are left out."""
    df = build_relations(spark, write_sources(spark, sf_dir, high_volume))[name]
    return df.drop("trip_id") if name == "fct_trips" else df


def fact_ids(spark: SparkSession, sf_dir: str, high_volume: int) -> DataFrame:
    """Rows, smallest, largest and number of different ids of the fact."""
    fact = build_relations(spark, write_sources(spark, sf_dir, high_volume))["fct_trips"]
    return fact.agg(
        F.count(F.lit(1)).alias("trips"),
        F.min("trip_id").alias("first_id"),
        F.max("trip_id").alias("last_id"),
        F.count_distinct("trip_id").alias("ids"),
    )


def report(spark: SparkSession, sf_dir: str, high_volume: int) -> DataFrame:
    """The report of the run, from what it counted while writing."""
    return pipeline.report(pipeline.prepare(spark, write_sources(spark, sf_dir, high_volume)))


def grown(spark: SparkSession, sf_dir: str, high_volume: int, name: str, month: str) -> DataFrame:
    """A relation after two runs: one before the file of ``month`` is there, and one that adds it."""
    conf = write_sources(spark, sf_dir, high_volume)
    folder = f"{conf.trips_dir}/{MONTH_FOLDER.format(month=month)}"
    late = spark.read.parquet(folder)
    aside = f"{conf.output_dir}-late"
    late.write.parquet(aside)
    storage.delete(spark, folder)
    build_relations(spark, conf)
    spark.read.parquet(aside).write.parquet(folder)
    df = build_relations(spark, conf)[name]
    return df.drop("trip_id") if name == "fct_trips" else df


def views(spark: SparkSession, sf_dir: str, high_volume: int) -> DataFrame:
    """What a user's SQL finds in the published views: their rows, and the ten best days in order."""
    build_relations(spark, write_sources(spark, sf_dir, high_volume))
    names = ("stg_yellow_trips", "stg_taxi_zones", "int_trips_enriched", "fct_trips", "dim_zones", "agg_daily_revenue", "agg_zone_performance")
    counts = [f"SELECT '{n}' AS name, 0 AS place, CAST(NULL AS DATE) AS day, COUNT(*) AS trips FROM {n}" for n in names]
    best = """
        SELECT 'best', row_number() OVER (ORDER BY total_revenue DESC, trip_date), trip_date, total_trips
        FROM (SELECT * FROM agg_daily_revenue ORDER BY total_revenue DESC, trip_date LIMIT 10)"""
    return spark.sql(" UNION ALL ".join([*counts, best]))


def ingested(spark: SparkSession, sf_dir: str, high_volume: int, start: str, end: str) -> DataFrame:
    """Staged trips of some months, from the registered table that the ingest made: other months are pruned."""
    conf = write_sources(spark, sf_dir, high_volume)
    name = f"trips_{uuid.uuid4().hex}"
    ingest(spark, conf.pattern, name, f"{conf.output_dir}/{name}")
    table = registered_table(spark, spark.catalog.currentDatabase(), name)
    inside = half_open(PICKUP, start, end, year="pickup_year", month="pickup_month")
    return stage_trips(table.where(inside))


def clustered_gaps(trips: DataFrame, start: str, end: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The longest gaps, from a table bucketed by zone and date; the trips are counted first, to have enough buckets."""
    spark = trips.sparkSession
    name = f"zone_days_{uuid.uuid4().hex}"
    save_by_zone_day(trips, name, bucket_number(trips.count(), bucket_rows), f"{shared_folder(spark)}/{name}")
    return max_gap_by_zone_day(spark.table(name), None, start, end)


def file_freshness(spark: SparkSession, sf_dir: str, high_volume: int, now: datetime) -> DataFrame:
    """Freshness of the month files from their footers: no column is read."""
    conf = write_sources(spark, sf_dir, high_volume)
    footers = refresh_footers(spark, conf.pattern, f"{conf.output_dir}/footers")
    return freshness(newest_pickup(spark, footers), PICKUP, now)


def historical(spark: SparkSession, sf_dir: str, high_volume: int) -> DataFrame:
    """The historical job's output, read back from its month folders."""
    conf = write_sources(spark, sf_dir, high_volume)
    path = f"{conf.output_dir}/history"
    run_historical(spark, f"{conf.trips_dir}/{MONTH_FOLDER.format(month='*')}", path)
    return spark.read.parquet(path)
