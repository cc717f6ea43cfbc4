"""Raw trips and zones derived from the driver's tables (formulas in FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from farebox.schemas import POSITION, position_columns

# Money in whole 1/100 and 1/10000 units: the decimal arithmetic of FIXTURES.md on BIGINT.
_PRICE = "CAST(rint(l_extendedprice * 100) AS BIGINT)"
_TIP = f"{_PRICE} * CAST(rint(l_discount * 100) AS BIGINT)"
_TOTAL = f"{_PRICE} * 100 - 15000000 + {_TIP} + IF(l_suppkey % 25 = 0, -30000000, 25000)"
_SECOND_OF_DAY = "(l_partkey * 7919 + l_suppkey * 104729 + l_linenumber * 611953) % 86400"
_LENGTH = "(l_partkey * 131 + l_suppkey * 17 + l_linenumber * 1009) % 12600 - 300"
_PICKUP = f"timestampadd(SECOND, IF(l_partkey % 97 <> 0, {_SECOND_OF_DAY}, NULL), o_orderdate)"
_DROPOFF = f"timestampadd(SECOND, {_SECOND_OF_DAY} + {_LENGTH}, o_orderdate)"


def _to_cents(units: str) -> str:
    """Whole cents of 1/10000 units, a half rounded away from zero."""
    return f"(({units}) + CAST(sign({units}) AS BIGINT) * 50) div 100"


_schemas: dict[str, StructType] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is read from the files once, not by a job in every query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def source_rows(spark: SparkSession, sf_dir: str) -> int:
    """Rows of the files that trips have their positions in; only footers are read."""
    return _table(spark, sf_dir, "lineitem").count()


def raw_trips(spark: SparkSession, sf_dir: str, positions: bool = False) -> DataFrame:
    """One trip per line item, in the raw schema, on request with its position in the lineitem files.

    The two timestamps come out of a generator so that filters on them are not
    rewritten in terms of their formulas, which would be computed again for each
    use. Real trip files store them as columns.
    """
    items = _table(spark, sf_dir, "lineitem")
    if positions:
        items = items.selectExpr(
            "*",
            f"xxhash64(_metadata.file_path) AS {POSITION[0]}",
            f"_metadata.row_index AS {POSITION[1]}",
        )
    orders = _table(spark, sf_dir, "orders")
    trips = items.join(orders, items.l_orderkey == orders.o_orderkey).selectExpr(
        "*",
        f"inline(array(struct({_PICKUP} AS tpep_pickup_datetime, {_DROPOFF} AS tpep_dropoff_datetime)))",
    )
    return trips.selectExpr(
        "CAST(l_linenumber AS BIGINT) AS VendorID",
        "IF(l_partkey % 13 <> 0, CAST(CAST(l_quantity AS BIGINT) % 6 AS DOUBLE), NULL) AS passenger_count",
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
        "l_suppkey AS PULocationID",
        "o_custkey % 130 AS DOLocationID",
        "(CAST(l_quantity AS BIGINT) - 2) / 2.0D AS trip_distance",
        f"({_PRICE} - 150000) / 100.0D AS fare_amount",
        "0.5D AS extra",
        "0.5D AS mta_tax",
        f"{_to_cents(_TIP)} / 100.0D AS tip_amount",
        "0.0D AS tolls_amount",
        "1.0D AS improvement_surcharge",
        f"{_to_cents(_TOTAL)} / 100.0D AS total_amount",
        "CAST(l_linenumber % 4 + 1 AS BIGINT) AS payment_type",
        *position_columns(items),
    )


def raw_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One zone per supplier, named after its nation; some suppliers are left out."""
    suppliers = _table(spark, sf_dir, "supplier").where("s_suppkey % 20 <> 7")
    nations = _table(spark, sf_dir, "nation")
    regions = _table(spark, sf_dir, "region")
    named = suppliers.join(nations, suppliers.s_nationkey == nations.n_nationkey).join(
        regions, nations.n_regionkey == regions.r_regionkey
    )
    return named.selectExpr(
        "s_suppkey AS LocationID",
        "r_name AS Borough",
        "n_name AS Zone",
        "CASE s_suppkey % 3 WHEN 0 THEN 'Zone A' WHEN 1 THEN 'Zone B' ELSE 'N/A' END AS service_zone",
    )
