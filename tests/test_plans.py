"""What the plans of the registered queries must and must not contain."""

import re

import pytest

import __spark_entry__ as driver
from tests.conftest import TESTDATA, plan_of

SF = f"{TESTDATA}/sf0.01"
JIT_LIMIT = 8000  # the JVM does not compile larger methods


@pytest.fixture
def plan(spark):
    def build(key, mode="formatted"):
        return plan_of(driver.trip_queries()[key](spark, SF), mode)

    return build


def test_zones_are_broadcast_and_trips_not_shuffled_for_them(plan):
    text = plan("enriched_trips")
    assert text.count("BroadcastHashJoin LeftOuter BuildRight") >= 2
    assert "SortMergeJoin" not in text and "hashpartitioning" not in text


@pytest.mark.parametrize("key", ["daily_revenue", "hour_pattern", "day_summary"])
def test_reports_without_zone_columns_join_no_zones(plan, key):
    assert "supplier" not in plan(key)


@pytest.mark.parametrize("key", ["zone_performance", "top_zones_by_month"])
def test_zone_reports_count_before_they_join(plan, key):
    tree = plan(key).split("\n(1) ")[0]
    # Trips are the first scan; two aggregates lie between it and the zone join.
    above_join, below_join = tree.split("BroadcastHashJoin LeftOuter", 1)
    assert below_join.count("HashAggregate") == 2 and above_join.count("HashAggregate") == 2


def test_top_zones_limit_each_group(plan):
    text = plan("top_zones_by_month")
    assert text.count("WindowGroupLimit") >= 2


def test_scans_read_only_their_columns(plan):
    schemas = re.findall(r"ReadSchema: struct<(.*?)>\n", plan("source_freshness"))
    read = {name.split(":")[0] for schema in schemas for name in schema.split(",")}
    assert read == {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "o_orderkey", "o_orderdate"}


@pytest.mark.parametrize("key", sorted(driver.trip_queries()))
def test_generated_code_is_small_enough_to_be_compiled(plan, conf, key):
    conf("spark.sql.adaptive.enabled", "false")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", plan(key, "codegen"))]
    assert sizes and max(sizes) < JIT_LIMIT
