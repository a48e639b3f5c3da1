"""Checks of sources, normalisation, loads, merges, logs, audits and streams."""

from __future__ import annotations

from tripstar.catalog.oracle_base import MONEY, as_double, money, query
from tripstar.catalog.oracle_marts import _DAILY, _HOURLY, _ROUNDED, _summary
from tripstar.operators.audits import (
    DAILY_REFERENCES,
    FACT_REFERENCES,
    FACT_REQUIRED,
    HOURLY_REFERENCES,
)
from tripstar.schemas import CANONICAL

_BAD_PAYMENT = "l_orderkey % 89 = 0"
_REJECTED = f"(file_type = 'yellow' AND {_BAD_PAYMENT})"
_KEPT = f"pickup_datetime IS NOT NULL AND NOT {_REJECTED}"
# what a load keeps: readable pickup, no reject; green forgives a bad payment type
_LOADED = f"""loaded AS (
  SELECT * EXCLUDE (trip_id, processed_at, l_orderkey, l_linestatus)
    REPLACE ({as_double("trip_distance", *MONEY)},
      CASE WHEN {_BAD_PAYMENT} THEN NULL ELSE payment_type END AS payment_type)
  FROM trips WHERE pickup_datetime IS NOT NULL AND NOT {_REJECTED})"""

_FROM_TRIPS = {
    "payment_type": f"CASE WHEN {_BAD_PAYMENT} THEN NULL ELSE payment_type END",
}
_TRIP_COLUMNS = [
    "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance", "payment_type",
    *MONEY, "trip_type", "vendor_id", "ratecode_id", "store_and_fwd_flag", "pu_location_id",
    "do_location_id", "dispatching_base_num", "affiliated_base_number", "sr_flag",
]
_SQL_TYPE = {"double": "DOUBLE", "string": "VARCHAR", "int": "INTEGER",
             "timestamp_ntz": "TIMESTAMP"}


def _canonical(available: dict[str, str]) -> str:
    return ", ".join(
        f"CAST({available.get(name, 'NULL')} AS {_SQL_TYPE[dtype.simpleString()]}) AS {name}"
        for name, dtype in CANONICAL.items()
    )


_ALIGNED = _canonical({c: _FROM_TRIPS.get(c, c) for c in _TRIP_COLUMNS})
_SECONDS = "((l_orderkey * 37 + l_partkey * 11) % 86400)"
_RIDE = "(CAST(l_quantity * 60 AS BIGINT) + l_linenumber * 7)"
_HIGH_VOLUME = _canonical(
    {
        "pickup_datetime": "CASE WHEN l_orderkey % 211 <> 0 THEN l_shipdate + "
        f"to_seconds(CAST({_SECONDS} AS BIGINT)) END",
        "dropoff_datetime": f"l_shipdate + to_seconds(CAST({_SECONDS} + {_RIDE} AS BIGINT))",
        "tolls_amount": "l_tax",
        "congestion_surcharge": "2.75",
        "airport_fee": "2.5",
        "pu_location_id": "l_suppkey % 8",
        "do_location_id": "l_partkey % 8",
        "hvfhs_license_num": "'HV0003'",
        "dispatching_base_num": "'B' || lpad(CAST(l_suppkey AS VARCHAR), 5, '0')",
        "originating_base_num": "'B' || lpad(CAST(l_partkey AS VARCHAR), 5, '0')",
        "trip_miles": "l_quantity / 2",
        "trip_time": _RIDE,
        "base_passenger_fare": "l_extendedprice",
        "bcf": "CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_discount END",
        "sales_tax": "l_tax",
        "tips": "l_discount",
        "driver_pay": "l_extendedprice",
        "shared_request_flag": "CASE WHEN l_linenumber = 1 THEN 'Y' ELSE 'N' END",
        "shared_match_flag": "CASE WHEN l_linenumber = 2 THEN 'Y' ELSE 'N' END",
        "access_a_ride_flag": "' '",
        "wav_request_flag": "CASE l_linestatus WHEN 'F' THEN 'Y' ELSE 'N' END",
        "wav_match_flag": "CASE l_linestatus WHEN 'O' THEN 'Y' ELSE 'N' END",
    }
)

_STAMP = "strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S')"

_SUMMARY = f"""SELECT file_type, year, month, COUNT(*) AS trips, COUNT(*) AS ids,
  SUM(CAST(total_amount AS DECIMAL(10,2))) AS exact, COUNT(payment_type) AS with_payment
  FROM loaded GROUP BY ALL"""
_LOADED_SUMMARY = f"SELECT * EXCLUDE (exact), {money('exact')} AS total_amount FROM ({_SUMMARY})"


def _routes(status: str, stamp: str) -> str:
    return f"""SELECT file_type, year, month, pu_location_id, do_location_id,
      COUNT(*) AS total_trips, {money("SUM(total_amount)")} AS total_amount,
      '{stamp}' AS created_at, '{stamp}' AS updated_at
    FROM trips WHERE l_linestatus = '{status}' GROUP BY ALL"""


_VERSIONS = f"""old AS ({_routes("F", "first")}),
new AS ({_routes("O", "second")}),
known AS (SELECT file_type, year, month, pu_location_id, do_location_id FROM old)"""
_SAME_KEY = " AND ".join(
    f"o.{k} IS NOT DISTINCT FROM n.{k}" for k in ("file_type", "year", "month", "pu_location_id", "do_location_id")
)
_UPDATED = f"""SELECT o.* REPLACE (
    CASE WHEN n.created_at IS NULL THEN o.total_trips ELSE n.total_trips END AS total_trips,
    CASE WHEN n.created_at IS NULL THEN o.total_amount ELSE n.total_amount END AS total_amount,
    CASE WHEN n.created_at IS NULL THEN o.updated_at ELSE n.updated_at END AS updated_at)
  FROM old o LEFT JOIN new n ON {_SAME_KEY}"""
_ADDED = f"SELECT * FROM new n WHERE NOT EXISTS (SELECT 1 FROM known o WHERE {_SAME_KEY})"

_RUN_LOG = """run_log AS (
  SELECT o_orderkey AS id, CAST(year(o_orderdate) AS INTEGER) AS year,
    CAST(month(o_orderdate) AS INTEGER) AS month,
    CASE o_custkey % 3 WHEN 0 THEN 'fact_trips' WHEN 1 THEN 'fact_trips_daily_agg'
      ELSE 'fact_trips_hourly_agg' END AS fact_table_name,
    CASE o_orderstatus WHEN 'O' THEN 'loaded' WHEN 'F' THEN 'failed' ELSE 'started' END AS status,
    o_custkey AS record_count, o_orderdate + to_seconds(o_orderkey % 86400) AS started_at
  FROM orders)"""
_LAST_RUN = """SELECT * FROM run_log QUALIFY ROW_NUMBER() OVER (
  PARTITION BY year, month, fact_table_name ORDER BY started_at DESC, id DESC) = 1"""
_FILE_EVENTS = """file_events AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
    CAST(month(o_orderdate) AS INTEGER) AS month,
    CASE o_custkey % 3 WHEN 0 THEN 'yellow' WHEN 1 THEN 'green' ELSE 'fhv' END AS file_type,
    CASE o_orderstatus WHEN 'O' THEN 'UPLOADED' WHEN 'F' THEN 'AVAILABLE' ELSE 'MISSING' END
      AS status, o_orderkey AS seq FROM orders)"""
_FILE_STATUS = """SELECT year, month, file_type, status FROM file_events QUALIFY ROW_NUMBER()
  OVER (PARTITION BY year, month, file_type ORDER BY seq DESC) = 1"""

_DIM_KEYS = {
    "dim_date": "date_key", "dim_time": "time_key", "dim_location": "location_id",
    "dim_vendor": "vendor_id", "dim_payment_type": "payment_type_id",
    "dim_rate_code": "ratecode_id", "dim_trip_type": "trip_type_id",
    "dim_file_source": "file_type", "dim_store_fwd_flag": "store_fwd_flag",
}


def _orphans(name: str, table: str, references: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{column}' AS column_name, '{dim}' AS dimension, "
        f"COUNT(*) AS orphan_rows FROM {table} t WHERE t.{column} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {dim} d WHERE d.{_DIM_KEYS[dim]} = t.{column})"
        for column, dim in references.items()
    )


def _duplicates(name: str, table: str, keys: str) -> str:
    return f"""SELECT '{name}' AS table_name, COUNT(*) AS duplicate_keys,
      CAST(ifnull(SUM(n - 1), 0) AS BIGINT) AS extra_rows FROM
      (SELECT COUNT(*) AS n FROM {table} GROUP BY {keys} HAVING COUNT(*) > 1) AS s"""


def _nulls(name: str, table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, "
        f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null_rows FROM {table}"
        for c in columns
    )


_NORMALIZED = "SELECT * FROM loaded WHERE file_type = '{}'"

OPERATION_CHECKS = {
    "scan_service_month": query(
        """SELECT file_type, year, month, COUNT(*) AS rows_in_file,
        COUNT(*) FILTER (WHERE pu_location_id IS NULL) AS without_place
        FROM trips GROUP BY ALL"""
    ),
    "case_insensitive_match": query(
        f"""SELECT file_type, CAST(vendor_id AS VARCHAR) AS VendorID,
          ifnull(CAST(pu_location_id AS VARCHAR), 'NaN') AS PULocationID,
          CAST(do_location_id AS VARCHAR) AS DOLocationID,
          CASE WHEN {_BAD_PAYMENT} THEN 'n/a' ELSE CAST(payment_type AS VARCHAR) END
            AS payment_type,
          CAST(total_amount AS DOUBLE) AS total_amount, CAST(NULL AS DOUBLE) AS fee
        FROM trips WHERE file_type <> 'fhv'"""
    ),
    "load_rejects": query(
        f"""SELECT file_type, year, month,
          CASE WHEN {_REJECTED} THEN 'payment_type' ELSE '' END AS bad_columns, COUNT(*) AS n
        FROM trips GROUP BY ALL"""
    ),
    "null_sentinels": query(
        f"""SELECT file_type, CAST(pu_location_id AS VARCHAR) AS place, {_STAMP} AS dropoff,
          CASE WHEN file_type <> 'fhv' THEN CAST(total_amount AS DOUBLE) END AS amount
        FROM trips
        UNION ALL SELECT 'fhvhv', CAST(l_suppkey % 8 AS VARCHAR),
          strftime(l_shipdate + to_seconds(CAST({_SECONDS} + {_RIDE} AS BIGINT)),
            '%Y-%m-%d %H:%M:%S'),
          CASE WHEN l_partkey % 50 <> 0 THEN l_discount END
        FROM lineitem WHERE l_returnflag = 'R'"""
    ),
    "file_inventory": query(
        "SELECT DISTINCT file_type, year, month, TRUE AS in_scope FROM trips"
    ),
    "normalize_yellow": query(_NORMALIZED.format("yellow"), _LOADED),
    "normalize_green": query(_NORMALIZED.format("green"), _LOADED),
    "normalize_fhv": query(_NORMALIZED.format("fhv"), _LOADED),
    "normalize_fhvhv": query(f"SELECT {_HIGH_VOLUME} FROM lineitem WHERE l_returnflag = 'R'"),
    "align_schema": query(f"SELECT {_ALIGNED} FROM trips"),
    "trip_data_union": query("SELECT * FROM loaded", _LOADED),
    "parse_timestamps": query("SELECT file_type, pickup_datetime, dropoff_datetime FROM trips"),
    "correct_numeric_types": query(
        f"""SELECT file_type, CAST(fare_amount AS DOUBLE) AS fare_amount,
          CAST(trip_distance AS DOUBLE) AS trip_distance,
          CAST(passenger_count AS DOUBLE) AS passenger_count,
          CAST({_FROM_TRIPS["payment_type"]} AS DOUBLE) AS payment_type FROM trips"""
    ),
    "filter_invalid_trips": query(
        """SELECT trip_id, file_type, CAST(fare_amount AS DOUBLE) AS fare_amount,
          CAST(trip_distance AS DOUBLE) AS trip_distance, passenger_count
        FROM trips WHERE fare_amount >= 0 AND trip_distance > 0 AND passenger_count > 0"""
    ),
    "target_month": query(
        """SELECT o_orderkey, CAST(year(o_orderdate) - 1 AS INTEGER) AS target_year,
        CAST(month(o_orderdate) AS INTEGER) AS target_month FROM orders"""
    ),
    "load_month_idempotent": query(_LOADED_SUMMARY, _LOADED),
    "load_outcomes": query(
        f"""SELECT file_type, 'loaded' AS status, COUNT(*) AS rows_in_file,
          COUNT(*) FILTER (WHERE pickup_datetime IS NOT NULL AND NOT {_REJECTED}) AS rows_loaded
        FROM trips GROUP BY file_type
        UNION ALL SELECT 'fhvhv', 'error', NULL, NULL"""
    ),
    "load_mixed_columns": query(
        """SELECT file_type, year, month, COUNT(*) AS trips,
          COUNT(airport_fee) FILTER (WHERE month % 2 = 0) AS with_fee
        FROM loaded WHERE file_type = 'yellow' GROUP BY ALL""",
        _LOADED,
    ),
    "load_corrected_month": query(
        f"""SELECT file_type, year, month, COUNT(*) FILTER (WHERE {_KEPT}) AS rows_loaded,
          COUNT(*) FILTER (WHERE {_KEPT}) AS trips, COUNT(*) FILTER (WHERE {_REJECTED}) AS rejects
        FROM trips WHERE file_type = 'yellow' GROUP BY ALL"""
    ),
    "load_past_bad_file": query(
        f"""SELECT file_type, 'incomplete' AS outcome, COUNT(DISTINCT year * 100 + month) AS loaded,
          CAST(1 AS BIGINT) AS failed, CAST(COUNT(*) FILTER (WHERE {_KEPT}) AS BIGINT) AS rows_loaded
        FROM trips WHERE file_type = 'green' GROUP BY file_type"""
    ),
    "load_late_file": query(
        """SELECT file_type, year, month, COUNT(*) AS trips, COUNT(*) AS ids,
          COUNT(*) FILTER (WHERE vendor_id = 1) AS ids_kept
        FROM loaded WHERE file_type = 'green' GROUP BY ALL""",
        _LOADED,
    ),
    "build_facts_incremental": query("SELECT * FROM daily", _DAILY),
    "summary_upsert": query(_summary("year", "month", _ROUNDED)),
    "file_status_next": query(
        f"""SELECT s.year, s.month, s.file_type,
          CASE WHEN t.year IS NOT NULL THEN 'UPLOADED' ELSE 'AVAILABLE' END AS status
        FROM ({_FILE_STATUS}) AS s LEFT JOIN (SELECT DISTINCT year, month, file_type FROM trips) AS t
          ON s.year = t.year AND s.month = t.month AND s.file_type = t.file_type
        WHERE (s.status <> 'UPLOADED' AND t.year IS NOT NULL) OR (s.status = 'MISSING' AND s.month <= 6)""",
        _FILE_EVENTS,
    ),
    "build_facts": query(
        """SELECT 'fact_trips' AS fact_table_name, 'loaded' AS status,
          (SELECT COUNT(*) FROM fact) AS record_count
        UNION ALL SELECT 'fact_trips_daily_agg', 'loaded', (SELECT COUNT(*) FROM daily)
        UNION ALL SELECT 'fact_trips_hourly_agg', 'loaded', (SELECT COUNT(*) FROM hourly)""",
        _DAILY, _HOURLY,
    ),
    "reconcile_counts": query(
        f"""SELECT *, rows_in_file - rows_loaded AS missing_rows FROM (
          SELECT file_type, year, month, COUNT(*) AS rows_in_file,
            COUNT(*) FILTER (WHERE pickup_datetime IS NOT NULL AND NOT {_REJECTED})
              AS rows_loaded FROM trips GROUP BY ALL) AS s"""
    ),
    "merge_insert_only": query(f"SELECT * FROM old UNION ALL {_ADDED}", _VERSIONS),
    "merge_update_only": query(_UPDATED, _VERSIONS),
    "merge_upsert": query(f"{_UPDATED} UNION ALL BY NAME {_ADDED}", _VERSIONS),
    "log_latest": query(_LAST_RUN, _RUN_LOG),
    "steps_to_run": query(
        f"""SELECT m.year, m.month, s.step AS fact_table_name, l.status AS last_status
        FROM (SELECT DISTINCT year, month FROM run_log) AS m
        CROSS JOIN (VALUES ('fact_trips'), ('fact_trips_daily_agg'), ('fact_trips_hourly_agg'))
          AS s(step)
        LEFT JOIN ({_LAST_RUN}) AS l ON l.year = m.year AND l.month = m.month
          AND l.fact_table_name = s.step
        WHERE l.status IS DISTINCT FROM 'loaded'""",
        _RUN_LOG,
    ),
    "file_status_latest": query(_FILE_STATUS, _FILE_EVENTS),
    "month_completeness": query(
        f"""SELECT year, month, COUNT(*) FILTER (WHERE status = 'UPLOADED') AS uploaded,
          COUNT(*) FILTER (WHERE status = 'UPLOADED') = 3 AS complete
        FROM ({_FILE_STATUS}) AS s GROUP BY year, month""",
        _FILE_EVENTS,
    ),
    "audit_pk_duplicates": query(
        " UNION ALL ".join(
            [
                _duplicates("fact_trips", "fact", "trip_id"),
                _duplicates("fact_trips_daily_agg", "(FROM daily UNION ALL FROM daily WHERE vendor_id = 2)",
                            "date_key, pickup_location_id, dropoff_location_id, file_type, "
                            "vendor_id"),
                _duplicates("fact_trips_hourly_agg", "(FROM hourly UNION ALL FROM hourly WHERE time_key >= 2200)",
                            "date_key, time_key, file_type, pickup_location_id"),
                _duplicates("file_events", "file_events", "file_type, year, month"),
            ]
        ),
        _DAILY, _HOURLY, _FILE_EVENTS,
    ),
    "audit_fk_orphans": query(
        " UNION ALL ".join(
            [
                _orphans("fact_trips", "fact", FACT_REFERENCES),
                _orphans("fact_trips_daily_agg", "daily", DAILY_REFERENCES),
                _orphans("fact_trips_hourly_agg", "hourly", HOURLY_REFERENCES),
            ]
        ),
        _DAILY, _HOURLY,
    ),
    "audit_not_null": query(
        _nulls("fact_trips", "fact", FACT_REQUIRED)
        + " UNION ALL "
        + _nulls("trip_data", "trips", ["file_type", "year", "month", "pickup_datetime"])
    ),
    "audit_stray_months": query(
        """SELECT file_type, CAST(pickup_date_key // 100 AS INTEGER) AS pickup_month,
          COUNT(*) FILTER (WHERE source_year * 100 + source_month <> pickup_date_key // 100)
            AS stray_trips,
          COUNT(*) AS month_trips
        FROM fact GROUP BY ALL HAVING stray_trips > 0"""
    ),
    "stream_ingest_available_now": query(_LOADED_SUMMARY, _LOADED),
    "stream_hourly_demand": query(
        """SELECT date_trunc('hour', ts) AS hour_start, event_type AS service, COUNT(*) AS trips,
            CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total_value
          FROM events GROUP BY 1, 2"""
    ),
    "stream_dedupe": query("SELECT DISTINCT trip_id FROM fact"),
    "stream_late_recompute": query("SELECT * FROM daily", _DAILY),
}
