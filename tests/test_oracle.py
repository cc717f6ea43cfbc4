"""Every registered query against its SQL, over the whole driver tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as driver
from tests.conftest import TESTDATA

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
SF = f"{TESTDATA}/sf0.01"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def normalized(names, found):
    order = sorted(range(len(names)), key=names.__getitem__)

    def text(value):
        if value is None or (isinstance(value, float) and math.isnan(value)):
            return ""
        return repr(value) if isinstance(value, float) else str(value)

    return [names[i] for i in order], sorted(tuple(text(row[i]) for i in order) for row in found)


def test_every_query_has_an_oracle():
    assert set(driver.trip_queries()) == set(driver.trip_sql())


@pytest.mark.parametrize("key", sorted(driver.trip_queries()))
def test_query_equals_oracle(spark, oracle, key):
    df = driver.trip_queries()[key](spark, SF)
    ours = normalized(df.columns, df.collect())
    cursor = oracle.execute(driver.trip_sql()[key])
    theirs = normalized([column[0] for column in cursor.description], cursor.fetchall())
    assert ours[0] == theirs[0]
    assert len(ours[1]) == len(theirs[1])
    assert ours[1] == theirs[1]


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_counts_agree_between_relations(spark):
    queries = driver.trip_queries()
    facts = queries["trip_facts"](spark, SF).count()
    assert queries["staged_trips"](spark, SF).count() > facts
    for key in ("daily_revenue", "zone_performance", "hour_pattern"):
        assert queries[key](spark, SF).agg({"total_trips": "sum"}).first()[0] == facts
    ranked = queries["top_zones_by_month"](spark, SF)
    assert ranked.where("revenue_rank = 1").select("month").distinct().count() == 12
