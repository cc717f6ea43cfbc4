import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from farebox.schemas import RAW_TRIPS, RAW_ZONES
from farebox.session import local_session

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    session = local_session(cores=8, shuffle_partitions=4, memory="6g", settings=settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def set_conf(name, value):
        before[name] = spark.conf.get(name, None)
        spark.conf.set(name, value)

    yield set_conf
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def at(text):
    return datetime.fromisoformat(text)


_TRIP = {
    "VendorID": 1,
    "passenger_count": 1.0,
    "tpep_pickup_datetime": "2023-01-05 10:00:00",
    "tpep_dropoff_datetime": "2023-01-05 10:20:00",
    "PULocationID": 1,
    "DOLocationID": 2,
    "trip_distance": 2.0,
    "fare_amount": 10.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 14.0,
    "payment_type": 1,
}


@pytest.fixture
def make_trips(spark):
    """Raw trips from partial rows; what a row leaves out is an ordinary valid value."""

    def make(*rows):
        full = []
        for row in rows:
            values = {**_TRIP, **row}
            for name in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
                if isinstance(values[name], str):
                    values[name] = at(values[name])
            full.append(tuple(values[f.name] for f in RAW_TRIPS))
        return spark.createDataFrame(full, RAW_TRIPS)

    return make


@pytest.fixture
def make_zones(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), RAW_ZONES)

    return make


@pytest.fixture
def zone_rows():
    return [
        (1, "North", "Harbor", "Zone A"),
        (2, "North", "Market", "Zone A"),
        (3, "South", "Market", "Zone B"),
        (4, "N/A", "Outside", "N/A"),
    ]


def trip(pickup, dropoff, **values):
    return {"tpep_pickup_datetime": pickup, "tpep_dropoff_datetime": dropoff, **values}


def rows(df):
    return [tuple(row) for row in df.collect()]


def plan_of(df, mode="formatted"):
    """The plan as text."""
    import contextlib
    import io

    buffer = io.StringIO()
    with contextlib.redirect_stdout(buffer):
        df.explain(mode)
    return buffer.getvalue()
