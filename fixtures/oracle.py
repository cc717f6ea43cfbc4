"""Independent SQL for every registered query, over the driver's tables in DuckDB.

Money is summed as DECIMAL(18,4). Names of common table expressions follow the
relations; ``_statement`` keeps those a query needs.
"""

from __future__ import annotations

import re

_RELATIONS = {
    "raw_trips": """
        SELECT CAST(l_linenumber AS BIGINT) AS "VendorID",
               CASE WHEN l_partkey % 97 <> 0 THEN o_orderdate + to_seconds(p) END AS tpep_pickup_datetime,
               o_orderdate + to_seconds(p + l) AS tpep_dropoff_datetime,
               CASE WHEN l_partkey % 13 <> 0 THEN CAST(CAST(l_quantity AS BIGINT) % 6 AS DOUBLE) END AS passenger_count,
               CAST((CAST(l_quantity AS BIGINT) - 2) / 2.0 AS DOUBLE) AS trip_distance,
               CAST(price - 1500 AS DOUBLE) AS fare_amount,
               CAST(0.5 AS DOUBLE) AS extra,
               CAST(0.5 AS DOUBLE) AS mta_tax,
               CAST(CAST(tip AS DECIMAL(18,2)) AS DOUBLE) AS tip_amount,
               CAST(0 AS DOUBLE) AS tolls_amount,
               CAST(1 AS DOUBLE) AS improvement_surcharge,
               CAST(CAST(price - 1500 + tip + CASE WHEN l_suppkey % 25 = 0 THEN -3000 ELSE 2.50 END
                    AS DECIMAL(18,2)) AS DOUBLE) AS total_amount,
               l_suppkey AS "PULocationID",
               o_custkey % 130 AS "DOLocationID",
               CAST(l_linenumber % 4 + 1 AS BIGINT) AS payment_type,
               pos
        FROM (SELECT *,
                     (l_partkey * 7919 + l_suppkey * 104729 + l_linenumber * 611953) % 86400 AS p,
                     (l_partkey * 131 + l_suppkey * 17 + l_linenumber * 1009) % 12600 - 300 AS l,
                     CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
                     CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS tip
              FROM (SELECT *, row_number() OVER () AS pos FROM lineitem)) items
        JOIN orders ON l_orderkey = o_orderkey""",
    "raw_zones": """
        SELECT s_suppkey AS "LocationID", r_name AS "Borough", n_name AS "Zone",
               CASE s_suppkey % 3 WHEN 0 THEN 'Zone A' WHEN 1 THEN 'Zone B' ELSE 'N/A' END AS service_zone
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        WHERE s_suppkey % 20 <> 7""",
    "staged": """
        SELECT "VendorID" AS vendor_id, passenger_count,
               tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime,
               "PULocationID" AS pickup_location_id, "DOLocationID" AS dropoff_location_id,
               trip_distance, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
               improvement_surcharge, total_amount, payment_type,
               date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime) AS trip_duration_minutes,
               pos
        FROM raw_trips WHERE tpep_pickup_datetime IS NOT NULL""",
    "zones": """
        SELECT "LocationID" AS location_id, "Borough" AS borough, "Zone" AS zone, service_zone FROM raw_zones""",
    "enriched": """
        SELECT vendor_id, pickup_datetime, dropoff_datetime,
               CAST(year(pickup_datetime) AS INTEGER) AS pickup_year,
               CAST(month(pickup_datetime) AS INTEGER) AS pickup_month,
               CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
               passenger_count, trip_distance, trip_duration_minutes, fare_amount, tip_amount, total_amount,
               pickup_location_id, zp.borough AS pickup_borough, zp.zone AS pickup_zone,
               dropoff_location_id, zd.borough AS dropoff_borough, zd.zone AS dropoff_zone,
               pos
        FROM staged
        LEFT JOIN zones zp ON pickup_location_id = zp.location_id
        LEFT JOIN zones zd ON dropoff_location_id = zd.location_id
        WHERE trip_distance > 0 AND fare_amount > 0 AND passenger_count > 0
          AND trip_duration_minutes BETWEEN 1 AND 180""",
    "facts": """
        SELECT row_number() OVER (ORDER BY pos) AS trip_id, * EXCLUDE (pos) FROM enriched""",
    "dimension": """
        SELECT DISTINCT location_id, borough, zone, service_zone FROM zones""",
}


def money_sum(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18,4))) AS DOUBLE)"


def money_avg(column: str) -> str:
    return f"{money_sum(column)} / count({column})"


def _statement(body: str) -> str:
    """The query with the relations it reads, directly or through others."""
    needed: set[str] = set()
    pending = [body]
    while pending:
        text = pending.pop()
        for name, sql in _RELATIONS.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                pending.append(sql)
    parts = [f"{name} AS ({sql})" for name, sql in _RELATIONS.items() if name in needed]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def oracle_sql(year: int, day: str, high_volume: int, now: str, months: tuple[str, str]) -> dict[str, str]:
    """SQL per query key, for the parameters the registered queries use."""
    in_year = f"pickup_datetime >= TIMESTAMP '{year}-01-01' AND pickup_datetime < TIMESTAMP '{year + 1}-01-01'"
    report = " UNION ALL ".join(
        f"SELECT '{relation}' AS relation, '{kind}' AS \"check\", '{column}' AS \"column\", count(*) AS failures FROM {rows}"
        for relation, kind, column, rows in (
            ("fct_trips", "not_null", "trip_id", "facts WHERE trip_id IS NULL"),
            ("fct_trips", "unique", "trip_id", "(SELECT trip_id FROM facts GROUP BY 1 HAVING count(*) > 1)"),
            ("fct_trips", "not_null", "pickup_datetime", "facts WHERE pickup_datetime IS NULL"),
            ("fct_trips", "not_null", "total_amount", "facts WHERE total_amount IS NULL"),
            ("fct_trips", "not_null", "fare_amount", "facts WHERE fare_amount IS NULL"),
            (
                "fct_trips",
                "in_range",
                "trip_duration_minutes",
                "facts WHERE trip_duration_minutes < 1 OR trip_duration_minutes > 180",
            ),
            ("fct_trips", "total_ge_fare", "total_amount", "facts WHERE total_amount < fare_amount"),
            ("dim_zones", "not_null", "location_id", "dimension WHERE location_id IS NULL"),
            ("dim_zones", "unique", "location_id", "(SELECT location_id FROM dimension GROUP BY 1 HAVING count(*) > 1)"),
        )
    )
    bodies = {
        "staged_trips": "SELECT * EXCLUDE (pos) FROM staged",
        "staged_zones": "SELECT * FROM zones",
        "enriched_trips": "SELECT * EXCLUDE (pos) FROM enriched",
        "trip_facts": "SELECT * FROM facts",
        "bitmap_facts": "SELECT * FROM facts",
        "dim_zones": "SELECT * FROM dimension",
        "daily_revenue": f"""
            SELECT CAST(pickup_datetime AS DATE) AS trip_date, count(*) AS total_trips,
                   {money_sum('total_amount')} AS total_revenue, {money_avg('fare_amount')} AS avg_fare,
                   {money_sum('tip_amount')} AS total_tips,
                   CASE WHEN {money_sum('total_amount')} > 0
                        THEN {money_sum('tip_amount')} / {money_sum('total_amount')} * 100 ELSE 0 END AS tip_rate_percent
            FROM enriched GROUP BY 1 ORDER BY 1""",
        "zone_performance": f"""
            SELECT *, rank() OVER (PARTITION BY pickup_year, pickup_month ORDER BY total_revenue DESC) AS revenue_rank,
                   total_trips > {high_volume} AS is_high_volume_zone
            FROM (SELECT pickup_zone, pickup_borough, pickup_year, pickup_month, count(*) AS total_trips,
                         avg(trip_distance) AS avg_trip_distance, {money_avg('fare_amount')} AS avg_fare,
                         {money_sum('total_amount')} AS total_revenue
                  FROM enriched GROUP BY ALL)""",
        "top_zones_by_month": f"""
            SELECT * FROM (
                SELECT *, rank() OVER (PARTITION BY month ORDER BY total_revenue DESC) AS revenue_rank
                FROM (SELECT CAST(date_trunc('month', pickup_datetime) AS TIMESTAMP) AS month, pickup_zone,
                             {money_sum('total_amount')} AS total_revenue
                      FROM enriched WHERE {in_year} GROUP BY ALL))
            WHERE revenue_rank <= 10 ORDER BY month, revenue_rank""",
        "hour_pattern": f"""
            SELECT hour_of_day, total_trips, avg_fare, round(avg_tip_pct, 9) AS avg_tip_pct,
                   avg(total_trips) OVER (ORDER BY hour_of_day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
                       AS rolling_3hr_avg_trips
            FROM (SELECT CAST(hour(pickup_datetime) AS INTEGER) AS hour_of_day, count(*) AS total_trips,
                         {money_avg('fare_amount')} AS avg_fare,
                         avg(CASE WHEN total_amount > 0 THEN tip_amount / total_amount ELSE 0 END) AS avg_tip_pct
                  FROM enriched GROUP BY 1)
            ORDER BY 1""",
        "max_gap_by_zone_day": f"""
            SELECT trip_date, pickup_zone, max(date_diff('minute', previous, pickup_datetime)) AS max_gap_minutes
            FROM (SELECT CAST(pickup_datetime AS DATE) AS trip_date, pickup_zone, pickup_datetime,
                         lag(dropoff_datetime) OVER (PARTITION BY pickup_zone, CAST(pickup_datetime AS DATE)
                                                     ORDER BY pickup_datetime, dropoff_datetime) AS previous
                  FROM enriched WHERE {in_year})
            WHERE previous IS NOT NULL GROUP BY 1, 2 ORDER BY 1, 3 DESC""",
        "historical_daily": f"""
            SELECT CAST(year(started) AS INTEGER) AS pickup_year, CAST(month(started) AS INTEGER) AS pickup_month,
                   CAST(day(started) AS INTEGER) AS pickup_day, count(*) AS total_trips,
                   {money_sum('fare_amount')} AS total_fare, {money_avg('fare_amount')} AS avg_fare,
                   {money_sum('tip_amount')} AS total_tips, {money_sum('total_amount')} AS total_revenue,
                   {money_sum('tip_amount')} / nullif({money_sum('total_amount')}, 0) * 100 AS tip_rate_percent
            FROM (SELECT *, tpep_pickup_datetime AS started,
                         (epoch(date_trunc('second', tpep_dropoff_datetime))
                          - epoch(date_trunc('second', tpep_pickup_datetime))) / 60 AS minutes
                  FROM raw_trips)
            WHERE trip_distance > 0 AND fare_amount > 0 AND passenger_count > 0 AND minutes >= 1 AND minutes <= 180
            GROUP BY 1, 2, 3""",
        "day_summary": f"""
            SELECT count(*) AS total_trips, {money_sum('total_amount')} AS total_revenue
            FROM enriched WHERE CAST(pickup_datetime AS DATE) = DATE '{day}'""",
        "check_not_null": "SELECT * EXCLUDE (pos) FROM enriched WHERE pickup_zone IS NULL",
        "check_unique": """
            SELECT location_id, count(*) AS n_records
            FROM (SELECT pickup_location_id AS location_id FROM staged) WHERE location_id IS NOT NULL
            GROUP BY 1 HAVING count(*) > 1""",
        "check_range": """
            SELECT * EXCLUDE (pos) FROM staged WHERE trip_duration_minutes < 1 OR trip_duration_minutes > 180""",
        "check_total_ge_fare": "SELECT * FROM facts WHERE total_amount < fare_amount",
        "quality_report": f"SELECT *, failures = 0 AS passed FROM ({report})",
        "source_profile": """
            SELECT 'all' AS level, CAST(NULL AS VARCHAR) AS value, count(*) AS row_count FROM raw_trips
            UNION ALL SELECT 'year', CAST(year(tpep_pickup_datetime) AS VARCHAR), count(*) FROM raw_trips GROUP BY 2
            UNION ALL SELECT 'date', CAST(CAST(tpep_pickup_datetime AS DATE) AS VARCHAR), count(*) FROM raw_trips GROUP BY 2""",
        "source_freshness": f"""
            SELECT newest AS max_loaded_at, date_diff('second', newest, TIMESTAMP '{now}') AS age_seconds,
                   CASE WHEN newest IS NULL OR TIMESTAMP '{now}' - newest > INTERVAL 2 DAY THEN 'error'
                        WHEN TIMESTAMP '{now}' - newest > INTERVAL 1 DAY THEN 'warn' ELSE 'pass' END AS status
            FROM (SELECT max(tpep_pickup_datetime) AS newest FROM raw_trips)""",
        "month_coverage": f"""
            SELECT strftime(m, '%Y-%m') AS month
            FROM (SELECT unnest(generate_series(DATE '{months[0]}', DATE '{months[1]}', INTERVAL 1 MONTH)) AS m)
            WHERE strftime(m, '%Y-%m') NOT IN
                  (SELECT strftime(tpep_pickup_datetime, '%Y-%m') FROM raw_trips WHERE tpep_pickup_datetime IS NOT NULL)""",
    }
    # The same relations from files: ids depend on the files, but are dense.
    bodies |= {
        "run_fct_trips": "SELECT * EXCLUDE (trip_id) FROM facts",
        "run_fct_trips_ids": """
            SELECT count(*) AS trips, min(trip_id) AS first_id, max(trip_id) AS last_id, count(DISTINCT trip_id) AS ids
            FROM facts""",
        "run_dim_zones": bodies["dim_zones"],
        "run_daily_revenue": bodies["daily_revenue"],
        "run_zone_performance": bodies["zone_performance"],
        "run_quality_report": bodies["quality_report"],
        "run_historical": bodies["historical_daily"],
        "clustered_max_gap": bodies["max_gap_by_zone_day"],
        "grown_fct_trips": "SELECT * EXCLUDE (trip_id) FROM facts",
        "grown_daily_revenue": bodies["daily_revenue"],
        "published_views": f"""
            SELECT 'stg_yellow_trips' AS name, 0 AS place, CAST(NULL AS DATE) AS day, count(*) AS trips FROM staged
            UNION ALL SELECT 'stg_taxi_zones', 0, NULL, count(*) FROM zones
            UNION ALL SELECT 'int_trips_enriched', 0, NULL, count(*) FROM enriched
            UNION ALL SELECT 'fct_trips', 0, NULL, count(*) FROM facts
            UNION ALL SELECT 'dim_zones', 0, NULL, count(*) FROM dimension
            UNION ALL SELECT 'agg_daily_revenue', 0, NULL, count(DISTINCT CAST(pickup_datetime AS DATE)) FROM enriched
            UNION ALL SELECT 'agg_zone_performance', 0, NULL, count(*)
                      FROM (SELECT DISTINCT pickup_zone, pickup_borough, pickup_year, pickup_month FROM enriched)
            UNION ALL SELECT * FROM (
                SELECT 'best', row_number() OVER (ORDER BY {money_sum('total_amount')} DESC, CAST(pickup_datetime AS DATE)) AS place,
                       CAST(pickup_datetime AS DATE), count(*)
                FROM enriched GROUP BY CAST(pickup_datetime AS DATE) ORDER BY place LIMIT 10)""",
        "ingested_trips": f"SELECT * EXCLUDE (pos) FROM staged WHERE {in_year}",
        "file_freshness": bodies["source_freshness"],
    }
    return {key: _statement(" ".join(body.split())) for key, body in bodies.items()}
