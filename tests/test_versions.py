"""Incremental runs, replacement that survives failure, footers, and the ingested table."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from farebox import storage, versions
from farebox.operators.staging import stage_trips
from farebox.plans import pipeline
from farebox.plans.historical import run_historical, update_historical
from farebox.plans.pipeline import PipelineConfig, QualityError, build_relations, prepare, published, run_for_date
from farebox.schemas import PICKUP
from farebox.sources import footers as footer_module
from farebox.sources import freshness, ingest, registered_table
from farebox.sources.checks import newest_pickup
from farebox.sources.footers import refresh_footers
from farebox.sources.trips import scan_trips
from tests.conftest import plan_of, rows, trip

ZONES = ["LocationID,Borough,Zone,service_zone", "1,N,Harbor,A", "2,N,Market,A", "3,S,Market,B"]


def month_of_trips(month, n, stray=None, **changes):
    trips = [
        trip(f"{month}-{1 + i % 5:02d} {i % 24:02d}:10:00", f"{month}-{1 + i % 5:02d} {i % 24:02d}:40:00", **{"PULocationID": 1 + i % 4, "tip_amount": i / 7} | changes)
        for i in range(n)
    ]
    return trips + ([trip(f"{stray}-28 10:00:00", f"{stray}-28 10:30:00")] if stray else [])


@pytest.fixture
def months(make_trips, tmp_path):
    """Writes the file of a month; the configuration reads them all."""

    def write(month, n, **changes):
        path = str(tmp_path / "in" / f"yellow_tripdata_{month}.parquet")
        make_trips(*month_of_trips(month, n, **changes)).coalesce(1).write.mode("overwrite").parquet(path)
        return path

    (tmp_path / "zones.csv").write_text("\n".join(ZONES) + "\n")
    write.conf = PipelineConfig(str(tmp_path / "in"), str(tmp_path / "zones.csv"), str(tmp_path / "out"), high_volume=3)
    return write


def contents(relations):
    out = {name: sorted(rows(df.drop("trip_id")), key=str) for name, df in relations.items()}
    out["ids"] = sorted(r[0] for r in rows(relations["fct_trips"].select("trip_id")))
    return out


def rebuilt(spark, conf, tmp_path):
    """The relations as a first run elsewhere builds them."""
    build_relations(spark, PipelineConfig(conf.trips_dir, conf.zones_csv, str(tmp_path / "again"), high_volume=conf.high_volume))
    return contents(published(spark, PipelineConfig(conf.trips_dir, conf.zones_csv, str(tmp_path / "again"))))


def folders(conf):
    """All data files below the output, with their change times."""
    found = {}
    for top, _, names in os.walk(conf.output_dir):
        found |= {os.path.join(top, n): os.stat(os.path.join(top, n)).st_mtime_ns for n in names if n.endswith(".parquet")}
    return {path: t for path, t in found.items() if "/versions/" not in path and "/footers/" not in path}


def test_a_new_file_is_read_alone_and_gives_what_a_rebuild_gives(spark, months, tmp_path):
    months("2023-01", 30, stray="2022-12")
    months("2023-02", 20)
    build_relations(spark, months.conf)
    before = folders(months.conf)
    ids = {r[1:]: r[0] for r in rows(published(spark, months.conf)["fct_trips"].where("pickup_month <> 3"))}

    months("2023-03", 25)
    draft = prepare(spark, months.conf)
    assert draft.read == ("2023-03",) and draft.rebuilt == (("2023", "3"),)
    new = set(folders(months.conf)) - set(before)
    assert new and all("pickup_year=2023/pickup_month=3/" in path for path in new)
    # the trips of other months are neither read nor written: their files could even be gone
    assert all("source_month=2023-03" in path for path in new if "agg_" not in path)
    pipeline.publish(draft)
    after = contents(published(spark, months.conf))
    assert after == rebuilt(spark, months.conf, tmp_path)
    assert after["ids"] == list(range(1, 77))
    # ids follow the pickup month, so those of the months before are as they were
    assert {r[1:]: r[0] for r in rows(published(spark, months.conf)["fct_trips"].where("pickup_month <> 3"))} == ids


def test_the_run_reads_no_trips_of_other_months(spark, months):
    old = months("2023-01", 30)
    months("2023-02", 20)
    build_relations(spark, months.conf)
    for name in os.listdir(old):  # same length and time, other bytes: reading it would fail
        path = os.path.join(old, name)
        if name.endswith(".parquet"):
            stat = os.stat(path)
            with open(path, "wb") as file:
                file.write(b"x" * stat.st_size)
            os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))
            crc = os.path.join(old, f".{name}.crc")
            os.path.exists(crc) and os.remove(crc)
    months("2023-03", 10)
    draft = prepare(spark, months.conf)
    pipeline.publish(draft)
    assert published(spark, months.conf)["fct_trips"].count() == 60
    assert [r.passed for r in pipeline.report(draft).collect()] == [True] * 9


def test_changes_give_what_a_rebuild_gives(spark, months, tmp_path):
    months("2023-01", 30, stray="2023-02")
    path = months("2023-02", 20, stray="2022-12")
    conf = months.conf
    build_relations(spark, conf)

    def check(conf, *read):
        draft = prepare(spark, conf)
        assert draft.read == read
        pipeline.publish(draft)
        assert contents(published(spark, conf)) == rebuilt(spark, conf, tmp_path)

    months("2023-02", 26, stray="2022-12", fare_amount=30.0, total_amount=40.0)
    check(conf, "2023-02")
    months("2023-02", 20)  # the only trip of a month goes
    check(conf, "2023-02")
    (tmp_path / "zones.csv").write_text("\n".join([*ZONES, "4,W,Outside,C"]) + "\n")
    check(conf, "2023-01", "2023-02")
    storage.delete(spark, path)
    conf = PipelineConfig(conf.trips_dir, conf.zones_csv, conf.output_dir, high_volume=1)
    check(conf, "2023-01")
    months("2023-02", 3)
    build_relations(spark, conf)
    storage.delete(spark, path)
    check(conf, "2023-02")


def test_nothing_new_writes_nothing(spark, months):
    months("2023-01", 10)
    build_relations(spark, months.conf)
    before = folders(months.conf)
    draft = prepare(spark, months.conf)
    assert draft.read == () == draft.rebuilt and folders(months.conf) == before
    assert versions.current(spark, months.conf.output_dir).number == 1
    build_relations(spark, months.conf)
    assert versions.current(spark, months.conf.output_dir).number == 1


def test_readers_keep_the_version_before_a_failure(spark, months, tmp_path, monkeypatch):
    months("2023-01", 30)
    build_relations(spark, months.conf)
    before = contents(published(spark, months.conf))
    opened = published(spark, months.conf)["fct_trips"]
    months("2023-01", 12)
    months("2023-02", 20)

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    real = versions.write_parts
    for module, name, broken in (
        (versions, "write_parts", lambda df, root, name, *a: fail() if name == "zone_sums" else real(df, root, name, *a)),
        (versions, "write_parts", lambda df, root, name, *a: fail() if name == "agg_zone_performance" else real(df, root, name, *a)),
        (storage, "touch", fail),
    ):
        with monkeypatch.context() as patch:
            patch.setattr(module, name, broken)
            with pytest.raises(RuntimeError, match="lost"):
                build_relations(spark, months.conf)
        assert contents(published(spark, months.conf)) == before
        assert opened.count() == 30
    build_relations(spark, months.conf)
    assert contents(published(spark, months.conf)) == rebuilt(spark, months.conf, tmp_path)


def test_a_failing_check_publishes_nothing(spark, months):
    months("2023-01", 30)
    run_for_date(spark, months.conf, "2023-01-02")
    before = contents(published(spark, months.conf))
    months("2023-02", 20, total_amount=1.0)
    with pytest.raises(QualityError, match="total_ge_fare: 20"):
        run_for_date(spark, months.conf, "2023-02-01")
    assert contents(published(spark, months.conf)) == before


def test_old_versions_go_and_what_newer_ones_need_stays(spark, months):
    for n in (10, 11, 12, 13):
        months("2023-01", n)
        months("2023-02", 5) if n == 10 else None
        build_relations(spark, months.conf)
    assert storage.complete(spark, f"{months.conf.output_dir}/versions", versions.READY) == [3, 4]
    assert published(spark, months.conf)["fct_trips"].count() == 18
    # two versions of month 1, one of month 2, which both versions share
    assert sum("/int_trips_enriched/" in path for path in folders(months.conf)) == 3


def test_no_trips_at_all(spark, months):
    months("2023-01", 0)
    relations = build_relations(spark, months.conf)
    assert {name: df.count() for name, df in relations.items()} == {
        "int_trips_enriched": 0, "fct_trips": 0, "dim_zones": 3, "agg_daily_revenue": 0, "agg_zone_performance": 0,
    }
    assert [r.passed for r in pipeline.report(prepare(spark, months.conf)).collect()] == [True] * 9


def test_a_report_reads_no_column_of_the_fact(spark, months):
    months("2023-01", 30, total_amount=1.0)
    draft = prepare(spark, months.conf)
    failed = {(r.check, r.column): r.failures for r in pipeline.report(draft).collect() if not r.passed}
    assert failed == {("total_ge_fare", "total_amount"): 30}
    stored = draft.rows(pipeline.TRIPS, pipeline.ENRICHED)
    assert "ReadSchema: struct<>" in plan_of(pipeline.file_starts(stored, ("pickup_year", "pickup_month")))


def test_footers_are_opened_once(spark, months, tmp_path, monkeypatch):
    months("2023-01", 3)
    months("2023-02", 4)
    folder = str(tmp_path / "footers")
    first = refresh_footers(spark, months.conf.pattern, folder)
    assert [r["rows"] for r in first] == [3, 4] and all(r.bounded for r in first)
    assert first[1]["last"] == datetime(2023, 2, 4, 3, 10)
    opened = []
    real = footer_module.read_footers
    monkeypatch.setattr(footer_module, "read_footers", lambda spark, listed, *a: opened.append(listed.count()) or real(spark, listed, *a))
    assert refresh_footers(spark, months.conf.pattern, folder) == first and opened == []
    months("2023-02", 6)
    third = refresh_footers(spark, months.conf.pattern, folder)
    assert opened == [1] and [r["rows"] for r in third] == [3, 6] and third[0] == first[0]
    storage.delete(spark, months("2023-01", 3))
    assert [r["rows"] for r in refresh_footers(spark, months.conf.pattern, folder)] == [6] and opened == [1]


def test_newest_pickup_reads_footers_where_they_tell(spark, months, tmp_path, make_trips, conf):
    months("2023-01", 3)
    months("2023-02", 4)
    found = refresh_footers(spark, months.conf.pattern, str(tmp_path / "footers"))
    newest = newest_pickup(spark, found)
    assert "FileScan" not in plan_of(newest) and newest.first()[0] == datetime(2023, 2, 4, 3, 10)
    assert freshness(newest, PICKUP, datetime(2023, 2, 5)).first().status == "pass"
    # old and zoned timestamps have no bounds to rely on: those files are scanned
    conf("spark.sql.parquet.outputTimestampType", "INT96")
    late = make_trips(trip("2023-03-09 10:00:00", "2023-03-09 11:00:00")).withColumn(PICKUP, F.col(PICKUP).cast("timestamp"))
    late.write.parquet(f"{months.conf.trips_dir}/yellow_tripdata_2023-03.parquet")
    empty = make_trips(trip(None, "2023-03-09 11:00:00"))
    empty.write.parquet(f"{months.conf.trips_dir}/yellow_tripdata_2023-04.parquet")
    found = refresh_footers(spark, months.conf.pattern, str(tmp_path / "footers"))
    assert {r.bounded for r in found if "2023-03" in r.path and r["rows"]} == {False}
    assert newest_pickup(spark, found).first()[0] == datetime(2023, 3, 9, 10)


def test_files_outside_given_bounds_are_not_read(spark, months, tmp_path):
    months("2023-01", 30, stray="2023-02")
    months("2023-02", 20)
    months("2023-03", 20)
    found = refresh_footers(spark, months.conf.pattern, str(tmp_path / "footers"))
    between = (datetime(2023, 2, 1), datetime(2023, 3, 1))
    some, all_ = scan_trips(spark, found, between=between), scan_trips(spark, found)
    assert len(some.inputFiles()) == 2
    inside = f"{PICKUP} >= '2023-02-01' AND {PICKUP} < '2023-03-01'"
    assert rows(some.where(inside)) == rows(all_.where(inside)) and some.where(inside).count() == 21
    assert scan_trips(spark, found, between=(datetime(2030, 1, 1), datetime(2031, 1, 1))).count() == 0


def test_an_ingested_table_is_pruned_by_month(spark, months, make_trips, tmp_path):
    months("2023-01", 30)
    months("2023-02", 20)
    make_trips(trip(None, "2023-01-01 10:00:00")).write.parquet(f"{months.conf.trips_dir}/yellow_tripdata_2023-05.parquet")
    table = ingest(spark, months.conf.pattern, "ingested_months", str(tmp_path / "table"))
    assert table.count() == 51
    again = registered_table(spark, "default", "ingested_months")
    month = again.where("pickup_year = 2023 AND pickup_month = 2")
    assert stage_trips(month).count() == 20
    plan = plan_of(month)
    assert "PartitionFilters: [isnotnull(pickup_year" in plan
    assert stage_trips(again).count() == 50
    statistics = spark.sql("DESCRIBE EXTENDED ingested_months").where("col_name = 'Statistics'").first()
    assert "51 rows" in statistics.data_type
    ingest(spark, months.conf.pattern, "ingested_months", str(tmp_path / "table"))
    assert spark.table("ingested_months").count() == 51
    spark.sql("DROP TABLE ingested_months")


def test_the_historical_job_replaces_touched_months_only(spark, months, tmp_path):
    path, pattern = str(tmp_path / "history"), months.conf.pattern
    first = months("2023-01", 30, stray="2022-12")
    months("2023-04", 20)

    def whole():
        run_historical(spark, pattern, str(tmp_path / "whole"))
        return sorted(rows(spark.read.parquet(str(tmp_path / "whole"))))

    def files():
        return {f for f in spark.read.parquet(path).inputFiles()}

    assert update_historical(spark, pattern, path) == [(2022, 12), (2023, 1), (2023, 4)]
    assert sorted(rows(spark.read.parquet(path))) == whole()
    before = files()
    assert update_historical(spark, pattern, path) == [] and files() == before
    months("2023-02", 10)
    assert update_historical(spark, pattern, path) == [(2023, 2)]
    assert before < files() and sorted(rows(spark.read.parquet(path))) == whole()
    before = {f for f in files() if "month=4/" in f or "month=2/" in f}
    months("2023-01", 12)  # the stray month has no trips any more
    assert update_historical(spark, pattern, path) == [(2022, 12), (2023, 1)]
    assert before < files() and sorted(rows(spark.read.parquet(path))) == whole()
    storage.delete(spark, first)
    assert update_historical(spark, pattern, path) == [(2023, 1)]
    assert sorted(rows(spark.read.parquet(path))) == whole()
