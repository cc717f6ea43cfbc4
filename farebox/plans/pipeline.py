"""The daily run: check the source, bring all relations up to date, test them, sum up the day.

A run reads the source months whose files are new or have changed since the published
version, and no others. What it writes is by source month and pickup month:

- ``int_trips_enriched``: the trips, which are the fact but for its ids;
- ``daily_sums`` and ``zone_sums``: counts and exact sums that the two KPI tables
  are added up from, and the violations of the data checks.

Only pickup months with a changed part are added up again. All else is taken over
from the version before, and one switch publishes the relations together.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import cached_property
from hashlib import sha256

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from farebox import versions
from farebox.operators.enrich import enrich, measure_zones
from farebox.operators.numbering import file_starts, number_written, repeated_ids
from farebox.operators.quality import CHECKS, Check, counted_report, quality_report, violation_counts
from farebox.operators.staging import stage_trips, stage_zones
from farebox.operators.zonal import zone_sums
from farebox.plans import marts
from farebox.plans.analytics import day_summary
from farebox.schemas import ENRICHED, FACT, POSITION, SOURCE_MONTH
from farebox.sinks import PICKUP_MONTH, cluster, publish_view
from farebox.sources.checks import MONTH_FILE, month_pattern, require_month_file
from farebox.sources.footers import listed_files, refresh_footers
from farebox.sources.trips import scan_trips
from farebox.sources.zones import read_zones
from farebox.versions import Part, SourceFile, Version

SORTED = ("pickup_zone", "pickup_datetime")
#: Partition columns of what a run writes per source month.
LEVELS = (SOURCE_MONTH, *PICKUP_MONTH)
#: Changes with the meaning of the stored sums, so that older versions are rebuilt.
LAYOUT = 1
TRIPS, DAILY, ZONAL = "int_trips_enriched", "daily_sums", "zone_sums"
ROW_CHECKS = tuple(c for c in CHECKS if c.relation == "fct_trips" and c.column != "trip_id")
ID_CHECKS = tuple(c for c in CHECKS if c.relation == "fct_trips" and c.column == "trip_id")


@dataclass(frozen=True)
class PipelineConfig:
    """Where the run reads and writes.

    Files are evenly sized and hold one month each. ``clustered`` also sorts them
    for reads by zone and time. Readers of the last ``keep_versions`` versions find their files.
    """

    trips_dir: str
    zones_csv: str
    output_dir: str
    month_file: str = MONTH_FILE
    high_volume: int = marts.HIGH_VOLUME_TRIPS
    clustered: bool = False
    keep_versions: int = 2

    @property
    def pattern(self) -> str:
        return f"{self.trips_dir}/{self.month_file.format(month='*')}"


@dataclass(frozen=True)
class RunResult:
    run_date: date
    summary: Row
    report: list[Row]


class QualityError(RuntimeError):
    """A data check found violating rows."""


@dataclass(frozen=True)
class Draft:
    """What a run has written and not published: the relations as they would be."""

    spark: SparkSession
    conf: PipelineConfig
    settings: str
    files: frozenset[SourceFile]
    parts: frozenset[Part]
    #: Source months that were read, and pickup months that were added up again.
    read: tuple[str, ...] = ()
    rebuilt: tuple[tuple[str, str], ...] = ()

    def rows(self, relation: str, schema: StructType, levels: Sequence[str] = ()) -> DataFrame:
        parts = [part for part in self.parts if part.relation == relation]
        return versions.read_parts(self.spark, self.conf.output_dir, parts, schema, levels)

    @cached_property
    def relations(self) -> dict[str, DataFrame]:
        """The relations by name. Ids follow pickup months, so those of the months before a new one stay."""
        trips, shapes = self.rows(TRIPS, ENRICHED), _shapes(self.spark)
        numbered = trips
        if any(part.relation == TRIPS for part in self.parts):
            numbered = number_written(trips, "trip_id", ENRICHED.names, PICKUP_MONTH)
        else:
            numbered = trips.withColumn("trip_id", F.lit(None).cast("bigint"))
        names = ("dim_zones", "agg_daily_revenue", "agg_zone_performance")
        return {TRIPS: trips, "fct_trips": numbered.select(*FACT.names)} | {n: self.rows(n, shapes[n]) for n in names}


def _shapes(spark: SparkSession) -> dict[str, StructType]:
    """Schemas of the stored relations, from plans over no rows."""
    trips = spark.createDataFrame([], ENRICHED).withColumn(SOURCE_MONTH, F.lit(""))
    daily, zonal = _daily_sums(trips), _zone_sums(trips)
    zones = spark.createDataFrame([], "location_id long, borough string, zone string, service_zone string")
    found = {
        DAILY: daily,
        ZONAL: zonal,
        "dim_zones": marts.dim_zones(zones),
        "agg_daily_revenue": marts.daily_report(daily),
        "agg_zone_performance": marts.zone_report(zonal, True),
    }
    return {name: df.schema for name, df in found.items()}


def _daily_sums(trips: DataFrame) -> DataFrame:
    return marts.daily_sums(trips, LEVELS, violation_counts(ROW_CHECKS))


def _zone_sums(trips: DataFrame) -> DataFrame:
    return zone_sums(trips, marts.ZONE, LEVELS, marts.zone_aggregates())


def _files_by_month(footers: Sequence[Row], month_file: str) -> dict[str, frozenset[SourceFile]]:
    found = defaultdict(set)
    for row in footers:
        match = re.search(month_pattern(month_file), row.path)
        unit = match[1] if match else "other"
        found[unit].add(SourceFile(unit, row.path, row.length, row.modified))
    return {unit: frozenset(files) for unit, files in found.items()}


def _settings(spark: SparkSession, conf: PipelineConfig) -> str:
    """Changes with all that each month's rows depend on beside its files: the zones and the threshold."""
    zones = sorted(map(tuple, listed_files(spark, conf.zones_csv).collect()))
    return sha256(repr((LAYOUT, conf.high_volume, zones)).encode()).hexdigest()


def prepare(spark: SparkSession, conf: PipelineConfig) -> Draft:
    """Write what changed since the published version; publish nothing.

    A source month is read if one of its files is new, gone or differs in length or change
    time. If the zones or the settings differ, all are.
    """
    root, before = conf.output_dir, versions.current(spark, conf.output_dir)
    footers = refresh_footers(spark, conf.pattern, f"{root}/footers")
    now, settings = _files_by_month(footers, conf.month_file), _settings(spark, conf)
    seen, old = defaultdict(set), frozenset()
    if before and before.settings == settings:
        old = before.parts
        for file in before.files:
            seen[file.unit].add(file)
    files = frozenset().union(*now.values())
    changed = {unit for unit in now if now[unit] != seen[unit]}
    gone = {unit for unit in seen if unit not in now}
    if before and before.settings == settings and not changed | gone:
        return Draft(spark, conf, settings, files, before.parts)

    run, order = versions.new_run(), SORTED if conf.clustered else ()
    by_source = [part for part in old if SOURCE_MONTH in part.values]
    replaced = {part for part in by_source if part.values[SOURCE_MONTH] in changed | gone}
    parts = set(old) - replaced
    zones = stage_zones(read_zones(spark, conf.zones_csv))
    dimension, shapes, added = measure_zones(zones), _shapes(spark), []
    if not any(part.relation == "dim_zones" for part in old):
        parts.update(versions.write_parts(marts.dim_zones(zones), root, "dim_zones", run))
    if changed:
        wanted = {file.path for unit in changed for file in now[unit]}
        raw = scan_trips(spark, [f for f in footers if f.path in wanted], month_in=month_pattern(conf.month_file))
        enriched = enrich(stage_trips(raw), dimension).select(*ENRICHED.names, SOURCE_MONTH)
        added = versions.write_parts(cluster(enriched, LEVELS, order), root, TRIPS, run, LEVELS)
        written = versions.read_parts(spark, root, added, ENRICHED, [SOURCE_MONTH])
        for name, sums in ((DAILY, _daily_sums(written)), (ZONAL, _zone_sums(written))):
            added += versions.write_parts(sums.repartition(*LEVELS), root, name, run, LEVELS)
    parts.update(added)

    months = {tuple(part.values[c] for c in PICKUP_MONTH) for part in [*replaced, *added]}
    in_months = lambda part: tuple(part.values.get(c) for c in PICKUP_MONTH) in months
    touched = [part for part in parts if SOURCE_MONTH in part.values and in_months(part)]
    of = lambda name: versions.read_parts(spark, root, [p for p in touched if p.relation == name], shapes[name])
    daily = marts.add_up(of(DAILY), [*PICKUP_MONTH, "trip_date"], marts.DAILY_SUMS)
    zonal = marts.add_up(of(ZONAL), [*marts.ZONE, *PICKUP_MONTH], list(marts.zone_aggregates()))
    merged = {
        "agg_daily_revenue": marts.daily_report(daily, PICKUP_MONTH).repartition(*PICKUP_MONTH).sortWithinPartitions(*PICKUP_MONTH, "trip_date"),
        "agg_zone_performance": marts.zone_report(zonal, dimension.broadcastable, conf.high_volume),
    }
    parts = {part for part in parts if part.relation not in merged or not in_months(part)}
    for name, mart in merged.items() if touched else ():
        parts.update(versions.write_parts(mart, root, name, run, PICKUP_MONTH))
    return Draft(spark, conf, settings, files, frozenset(parts), tuple(sorted(changed | gone)), tuple(sorted(months)))


def report(draft: Draft) -> DataFrame:
    """The report of the data checks, without a pass over the fact.

    Violations of checks on single rows were counted with the daily sums of each
    source month. Ids are offsets of files plus row indexes, so their uniqueness shows in the
    offsets. The rows in the footers must be those that were summed.
    """
    shapes = _shapes(draft.spark)
    counts = [F.coalesce(F.sum(f"check_{i}"), F.lit(0)).alias(f"check_{i}") for i in range(len(ROW_CHECKS))]
    summed = draft.rows(DAILY, shapes[DAILY]).agg(F.coalesce(F.sum("trips"), F.lit(0)).alias("trips"), *counts).first()
    ids = Row(rows=0, repeated=0)
    if any(part.relation == TRIPS for part in draft.parts):
        ids = repeated_ids(file_starts(draft.rows(TRIPS, ENRICHED), PICKUP_MONTH)).first()
    if ids.rows != summed.trips:
        raise RuntimeError(f"{ids.rows} trips are stored, {summed.trips} were summed")
    failures: dict[Check, int] = {check: summed[f"check_{i}"] for i, check in enumerate(ROW_CHECKS)}
    failures |= {check: ids.repeated if check.kind == "unique" else 0 for check in ID_CHECKS}
    of_zones = [check for check in CHECKS if check.relation == "dim_zones"]
    zones = quality_report({"dim_zones": draft.relations["dim_zones"]}, of_zones)
    return counted_report(failures, draft.spark).unionByName(zones)


def publish(draft: Draft) -> dict[str, DataFrame]:
    """Switch readers to the draft and publish the views."""
    spark, conf = draft.spark, draft.conf
    before = versions.current(spark, conf.output_dir)
    if before is None or (before.settings, before.files, before.parts) != (draft.settings, draft.files, draft.parts):
        versions.publish(spark, conf.output_dir, draft.settings, draft.files, draft.parts)
        versions.drop_old(spark, conf.output_dir, conf.keep_versions)
    staged = stage_trips(scan_trips(spark, refresh_footers(spark, conf.pattern, f"{conf.output_dir}/footers")))
    publish_view(staged.drop(*POSITION), "stg_yellow_trips")
    publish_view(stage_zones(read_zones(spark, conf.zones_csv)), "stg_taxi_zones")
    for name, df in draft.relations.items():
        publish_view(df, name)
    return draft.relations


def published(spark: SparkSession, conf: PipelineConfig) -> dict[str, DataFrame]:
    """The relations of the published version, as a reader of the output finds them."""
    version: Version | None = versions.current(spark, conf.output_dir)
    if version is None:
        raise FileNotFoundError(f"no published version in {conf.output_dir}")
    return Draft(spark, conf, version.settings, version.files, version.parts).relations


def build_relations(spark: SparkSession, conf: PipelineConfig) -> dict[str, DataFrame]:
    """Bring all relations up to date and publish them, whatever the checks would say."""
    return publish(prepare(spark, conf))


def run_for_date(
    spark: SparkSession, conf: PipelineConfig, run_date: date | str, strict: bool = True
) -> RunResult:
    """One daily run. A run over unchanged sources reads and writes no trips.

    With ``strict`` a failing check stops the run before it publishes: readers keep the version before.
    """
    require_month_file(spark, conf.trips_dir, run_date, conf.month_file)
    draft = prepare(spark, conf)
    found = report(draft).collect()
    failed = [line for line in found if not line.passed]
    if strict and failed:
        raise QualityError("; ".join(f"{r.relation}.{r.column} {r.check}: {r.failures}" for r in failed))
    relations = publish(draft)
    summary = day_summary(relations["fct_trips"], run_date).first()
    return RunResult(date.fromisoformat(str(run_date)), summary, found)
