"""The same queries in standard SQL, for comparison on another engine."""

from __future__ import annotations

_TRIPS = """
WITH trips_ev AS (
    SELECT event_id AS trip_id, ts AS pickup_datetime, value AS tip_amount,
           nullif(event_type, 'error') AS dispatching_base_num, event_type AS raw_base
    FROM events
)
"""

_ZONES = """
WITH zones AS (
    SELECT n_nationkey AS "LocationID", n_name AS "Zone" FROM nation
), zone_trips AS (
    SELECT o_orderdate AS pickup_datetime, l_shipdate AS dropoff_datetime,
           s_nationkey AS "PULocationID", c_nationkey AS "DOLocationID",
           l_extendedprice AS total_amount
    FROM lineitem
    JOIN orders ON o_orderkey = l_orderkey
    JOIN customer ON c_custkey = o_custkey
    JOIN supplier ON s_suppkey = l_suppkey
)
"""

# The average, then rounded once, halves away from zero. In millionths m of n positive amounts it is
# m / (10000 * n) cents, rounded (2 * m + 10000 * n) div (20000 * n).
_AVERAGE_FARE = """
CAST((2 * CAST(sum(CAST(total_amount AS DECIMAL(18, 6))) * 1000000 AS HUGEINT) + 10000 * count(*))
     // (20000 * count(*)) AS DOUBLE) / 100 AS average_fare
"""

_IN_RANGE = """
CAST(pickup_datetime AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
"""

_BASES = "raw_base IN ('click', 'view', 'error')"

_ORDERED = """
SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS "index"
FROM orders
"""

_MAX_TIPS = """
SELECT CAST(pickup_datetime AS DATE) AS trip_date, max(tip_amount) AS max_tip_amount
FROM trips_ev
WHERE date_part('year', pickup_datetime) = 2024 AND date_part('month', pickup_datetime) = 1
GROUP BY CAST(pickup_datetime AS DATE)
"""

_DAILY_COUNTS = """
SELECT CAST(pickup_datetime AS DATE) AS trip_date, count(*) AS trip_count
FROM trips_ev GROUP BY CAST(pickup_datetime AS DATE)
"""

_BY_MONTH = "SELECT *, strftime(o_orderdate, '%Y-%m') AS month FROM orders"

_EVENTS_BY_DAY = "SELECT *, CAST(ts AS DATE) AS pickup_date FROM events"

_COUNT_IN_RANGE = f"{_TRIPS} SELECT count(*) AS trips FROM trips_ev WHERE {_IN_RANGE}"

ORACLE: dict[str, str] = {
    # Sources
    "scan_csv_inferred": "SELECT * FROM supplier",
    "scan_csv_chunked": """
        SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS line_count,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(12, 2))) * 100 AS BIGINT) AS price_cents,
               CAST(sum(CAST(l_quantity AS DECIMAL(12, 2))) * 100 AS BIGINT) AS quantity_cents,
               CAST(sum(CAST(l_discount AS DECIMAL(12, 2))) * 100 AS BIGINT) AS discount_cents,
               CAST(sum(CAST(l_tax AS DECIMAL(12, 2))) * 100 AS BIGINT) AS tax_cents,
               CAST(sum(l_orderkey) AS BIGINT) AS l_orderkey_sum,
               CAST(sum(l_partkey) AS BIGINT) AS l_partkey_sum,
               CAST(sum(l_suppkey) AS BIGINT) AS l_suppkey_sum,
               max(l_orderkey) AS l_orderkey_max, max(l_partkey) AS l_partkey_max,
               max(l_suppkey) AS l_suppkey_max,
               min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship, max(l_tax) AS max_tax
        FROM lineitem GROUP BY l_returnflag, l_linestatus, l_linenumber
    """,
    "scan_csv_typed": "SELECT * FROM events",
    "external_table_single": "SELECT * FROM part",
    "external_table_glob": """
        SELECT * REPLACE (CASE WHEN ts >= DATE '2024-01-15' THEN props END AS props) FROM events
    """,
    "scan_table": "SELECT * FROM customer",
    "monthly_source_paths": """
        SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS trips FROM orders GROUP BY 1
    """,
    # Loads that check, remember and prune
    "load_quarantine": """
        SELECT CASE WHEN event_id % 97 = 0 THEN 'ts: yesterday'
                    WHEN event_id % 89 = 0 THEN 'value: much' ELSE 'good' END AS verdict,
               count(*) AS loaded, CAST(sum(event_id) AS BIGINT) AS ids
        FROM events GROUP BY 1
    """,
    "load_ledger": """
        SELECT month, n AS rows, CASE WHEN twice THEN 2 ELSE 1 END::BIGINT AS loads, n AS landed FROM (
            SELECT month, twice, CAST(count(*) * CASE WHEN twice THEN 2 ELSE 1 END AS BIGINT) AS n
            FROM (SELECT strftime(o_orderdate, '%Y-%m') AS month, month IN ('1996-02', '2000-11') AS twice
                  FROM orders)
            GROUP BY month, twice)
    """,
    "append_key_guard": """
        SELECT * FROM orders WHERE o_orderdate < DATE '1998-01-01' AND o_orderkey % 7 = 0
    """,
    "clustered_base_scan": """
        SELECT *, CAST(ts AS DATE) AS event_day FROM events WHERE event_type IN ('click', 'error')
    """,
    "trips_for_bases_cost": """
        SELECT count(*) AS rows, true AS part FROM events
        WHERE ts >= DATE '2024-01-05' AND ts < DATE '2024-01-21'
    """,
    # Sinks and publication
    "sink_table_replace": "SELECT * FROM supplier",
    "sink_create_empty": "SELECT * FROM orders WHERE false",
    "sink_table_append": "SELECT * FROM events",
    "row_ordinal": _ORDERED,
    "row_ordinal_source": _ORDERED,
    "convert_csv_parquet": "SELECT * FROM events",
    "land_raw": "SELECT * FROM customer",
    "relayout_by_dataset": _BY_MONTH,
    "ctas_partitioned": _EVENTS_BY_DAY,
    "ctas_partitioned_except": _EVENTS_BY_DAY,
    "registry_fanout": """
        SELECT 'yellow' AS dataset, CAST(ts AS DATE) AS pickup_date, count(*) AS trips
        FROM events GROUP BY CAST(ts AS DATE)
        UNION ALL
        SELECT 'green', CAST(o_orderdate AS DATE), count(*)
        FROM orders GROUP BY CAST(o_orderdate AS DATE)
        UNION ALL
        SELECT 'fhv', CAST(ts AS DATE), count(*)
        FROM events GROUP BY CAST(ts AS DATE)
    """,
    "monthly_backfill": _BY_MONTH,
    "monthly_landing_stream": _BY_MONTH,
    "load_row_count": """
        SELECT 'orders' AS table_name, count(*) AS source_rows, count(*) AS loaded_rows FROM orders
    """,
    "key_check": """
        SELECT l_orderkey, l_linenumber, count(*) AS row_count
        FROM lineitem GROUP BY l_orderkey, l_linenumber
        HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL
    """,
    "clustered_layout": """
        SELECT event_id, ts AS dropoff_datetime, user_id, event_type AS dispatching_base_num,
               value, props, CAST(ts AS DATE) AS dropoff_date
        FROM events
        WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
        ORDER BY event_type
    """,
    # Projections
    "project_star": "SELECT * FROM events",
    "project_except": "SELECT event_id, ts, user_id, event_type, value FROM events",
    "project_alias": f"""{_TRIPS}
        SELECT trip_id, CAST(pickup_datetime AS DATE) AS trip_date, tip_amount AS tip FROM trips_ev
    """,
    "distinct_project": f"""{_TRIPS}
        SELECT DISTINCT dispatching_base_num FROM trips_ev WHERE {_IN_RANGE}
    """,
    # Filters
    "filter_date_eq": f"""{_TRIPS}
        SELECT * FROM trips_ev WHERE CAST(pickup_datetime AS DATE) = DATE '2024-01-15'
    """,
    "filter_year_month": """
        SELECT * FROM orders
        WHERE date_part('year', o_orderdate) = 1997 AND date_part('month', o_orderdate) = 3
    """,
    "filter_date_between": f"{_TRIPS} SELECT * FROM trips_ev WHERE {_IN_RANGE}",
    "filter_string_eq": f"""{_ZONES}
        SELECT t.*, z."Zone" AS pickup_zone
        FROM zone_trips t JOIN zones z ON z."LocationID" = t."PULocationID"
        WHERE z."Zone" = 'NATION_15'
    """,
    "filter_in_list": f"{_TRIPS} SELECT * FROM trips_ev WHERE {_BASES}",
    "filter_not_in_list": f"""{_ZONES}
        SELECT "PULocationID", "DOLocationID", count(*) AS trip_count FROM zone_trips
        WHERE "PULocationID" NOT IN (23, 24) AND "DOLocationID" NOT IN (23, 24)
        GROUP BY "PULocationID", "DOLocationID"
    """,
    "filter_conjunction": f"{_TRIPS} SELECT * FROM trips_ev WHERE {_IN_RANGE} AND {_BASES}",
    # Joins
    "join_dim_inner": """
        SELECT c_custkey, n_nationkey AS "PULocationID", n_name AS pickup_zone
        FROM customer JOIN nation ON n_nationkey = nullif(c_nationkey, 7)
    """,
    "join_dim_role_playing": f"""{_ZONES}
        SELECT pu."Zone" AS pickup_zone, d."Zone" AS dropoff_zone, count(*) AS trip_count
        FROM zone_trips t
        JOIN zones pu ON pu."LocationID" = t."PULocationID"
        JOIN zones d ON d."LocationID" = t."DOLocationID"
        GROUP BY pu."Zone", d."Zone"
    """,
    # Aggregations
    "count_global": "SELECT count(*) AS trips FROM lineitem",
    "count_by_group": f"""{_ZONES}
        SELECT "DOLocationID", count(*) AS trip_count FROM zone_trips GROUP BY "DOLocationID"
    """,
    "max_by_day": f"""{_TRIPS}
        SELECT CAST(pickup_datetime AS DATE) AS trip_date, max(tip_amount) AS max_tip_amount
        FROM trips_ev GROUP BY CAST(pickup_datetime AS DATE)
    """,
    "avg_by_pair": f"""{_ZONES}
        SELECT "PULocationID", "DOLocationID", {_AVERAGE_FARE} FROM zone_trips
        GROUP BY "PULocationID", "DOLocationID"
    """,
    "distinct_count": f"""{_TRIPS}
        SELECT count(*) AS bases FROM (SELECT DISTINCT dispatching_base_num FROM trips_ev) d
    """,
    # Sorts and limits
    "sort_asc": f"{_TRIPS} {_DAILY_COUNTS} ORDER BY trip_date ASC NULLS LAST",
    "sort_desc": f"""{_TRIPS} {_DAILY_COUNTS}
        ORDER BY trip_count DESC NULLS FIRST, trip_date DESC NULLS FIRST
    """,
    "top_1": f"{_TRIPS} {_DAILY_COUNTS} ORDER BY trip_count DESC, trip_date ASC LIMIT 1",
    # Scalar functions
    "fn_to_timestamp": f"""{_TRIPS}
        SELECT trip_id, CAST(CAST(pickup_datetime AS VARCHAR) AS TIMESTAMP) AS pickup_datetime
        FROM trips_ev
    """,
    "fn_date": f"""{_TRIPS}
        SELECT trip_id, CAST(date_trunc('day', pickup_datetime) AS DATE) AS trip_date FROM trips_ev
    """,
    "fn_date_part": """
        SELECT o_orderkey, CAST(date_part('year', o_orderdate) AS INTEGER) AS year,
               CAST(date_part('month', o_orderdate) AS INTEGER) AS month
        FROM orders
    """,
    "fn_cast_date": f"""{_TRIPS}
        SELECT trip_id, CAST(pickup_datetime AS DATE) AS trip_date FROM trips_ev
    """,
    "fn_round_numeric": """
        SELECT l_shipdate, CAST(sum(net) * 100 AS BIGINT) AS net_cents,
               CAST(max(net) AS DOUBLE) AS max_net
        FROM (
            SELECT l_shipdate, round(CAST(l_extendedprice AS DECIMAL(12, 2))
                                     * (1 - CAST(l_discount AS DECIMAL(4, 2))), 2) AS net
            FROM lineitem
        ) r
        GROUP BY l_shipdate
    """,
    # Named questions
    "trips_on_day": f"""{_TRIPS}
        SELECT count(*) AS trips FROM trips_ev
        WHERE CAST(pickup_datetime AS DATE) = DATE '2024-01-15'
    """,
    "daily_max_tip": f"{_TRIPS} {_MAX_TIPS} ORDER BY trip_date",
    "top_tip_day": f"{_TRIPS} {_MAX_TIPS} ORDER BY max_tip_amount DESC, trip_date ASC LIMIT 1",
    "top_destination": f"""{_ZONES}
        SELECT max(d."Zone") AS dropoff_zone, count(*) AS trip_count
        FROM zone_trips t
        JOIN zones pu ON pu."LocationID" = t."PULocationID"
        JOIN zones d ON d."LocationID" = t."DOLocationID"
        WHERE pu."Zone" = 'NATION_15'
          AND CAST(t.pickup_datetime AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'
        GROUP BY d."LocationID"
        ORDER BY trip_count DESC, d."LocationID" ASC LIMIT 1
    """,
    "priciest_pair": f"""{_ZONES}
        SELECT max(pu."Zone") AS pickup_zone, max(d."Zone") AS dropoff_zone, {_AVERAGE_FARE}
        FROM zone_trips t
        JOIN zones pu ON pu."LocationID" = t."PULocationID"
        JOIN zones d ON d."LocationID" = t."DOLocationID"
        WHERE d."LocationID" NOT IN (23, 24) AND pu."LocationID" NOT IN (23, 24)
        GROUP BY pu."LocationID", d."LocationID"
        ORDER BY average_fare DESC, pu."LocationID" ASC, d."LocationID" ASC LIMIT 1
    """,
    "trips_in_range": _COUNT_IN_RANGE,
    "trips_in_range_partitioned": _COUNT_IN_RANGE,
    "distinct_bases": f"""{_TRIPS}
        SELECT count(*) AS bases
        FROM (SELECT DISTINCT dispatching_base_num FROM trips_ev WHERE {_IN_RANGE}) d
    """,
    "trips_for_bases": f"""{_TRIPS}
        SELECT count(*) AS trips FROM trips_ev WHERE {_IN_RANGE} AND {_BASES}
    """,
}
