"""Checks of the queries over stored, merged and kept-up aggregates; all on detail rows."""

from __future__ import annotations

from tripstar.catalog.oracle_base import query
from tripstar.catalog.oracle_marts import _DAILY, _HOURLY, _LOCATED, _ROUTE, _STAR, FACT_CHECKS
from tripstar.catalog.oracle_operations import OPERATION_CHECKS
from tripstar.operators.rollups import PRECISION

_ACTIVE = """COUNT(DISTINCT pickup_date_key) AS active_days, COUNT(DISTINCT pickup_location_id) AS pickup_places,
    COUNT(DISTINCT dropoff_location_id) AS dropoff_places, COUNT(DISTINCT vendor_id) AS vendors"""
_YEAR_MONTH = """CAST(pickup_date_key // 10000 AS INTEGER) AS year,
    CAST(pickup_date_key // 100 % 100 AS INTEGER) AS month"""

_PERCENTS = (25, 50, 75, 95)


def _width(value: str) -> str:
    return f"CAST(pow(2, greatest(length(bin(abs({value}))) - {PRECISION + 1}, 0)) AS BIGINT)"


def _middle(found: str) -> str:
    return f"{found} + CASE WHEN {found} < 0 THEN -1 ELSE 1 END * (({_width(found)} - 1) // 2)"


_CENTS = """cents AS (
  SELECT file_type, CAST(dayofweek(strptime(CAST(pickup_date_key AS VARCHAR), '%Y%m%d')) + 1 AS INTEGER) AS day_of_week,
    CAST(pickup_time_key // 100 AS INTEGER) AS hour, CAST(total_amount * 100 AS BIGINT) AS c
  FROM fact WHERE total_amount IS NOT NULL)"""


def _quantiles(by: str) -> str:
    """The exact quantiles by rank, then the class of each."""
    found = ", ".join(
        f"max(c) FILTER (WHERE k = greatest((n * {p} + 99) // 100, 1)) AS q{p}" for p in _PERCENTS
    )
    classes = ", ".join(f"q{p} - q{p} % {_width(f'q{p}')} AS p{p}" for p in _PERCENTS)
    return f"""SELECT {by}, n, {classes} FROM (
      SELECT {by}, max(n) AS n, {found} FROM (
        SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY c) AS k, count(*) OVER (PARTITION BY {by}) AS n FROM cents)
      GROUP BY {by})"""


_SLOTS = "file_type, day_of_week, hour"
_MIDDLES = ", ".join(f"{_middle(f'p{p}')} AS p{p}_estimate" for p in _PERCENTS)
_ESTIMATES = ", ".join(f"{_middle(f'p{p}')} AS e{p}" for p in _PERCENTS)
_RANKS = ", ".join(f"count(*) FILTER (WHERE c < e{p}) AS b{p}, count(*) FILTER (WHERE c <= e{p}) AS u{p}" for p in _PERCENTS)
_ERRORS = ", ".join(
    f"""CAST(max(greatest(b{p} + 1 - greatest((n * {p} + 99) // 100, 1),
      greatest((n * {p} + 99) // 100, 1) - greatest(u{p}, 1), 0) * 10000 // n) AS BIGINT) AS p{p}_error"""
    for p in _PERCENTS
)

_LEFT = "left_over AS (SELECT * FROM fact WHERE payment_type_id <> 3)"

_MONTHLY = ("file_type", "year", "month")

UPKEEP_CHECKS: dict[str, str] = {
    "monthly_actives": query(
        f"""SELECT file_type, {_YEAR_MONTH}, {_ACTIVE} FROM fact GROUP BY ALL
        UNION ALL SELECT 'all', {_YEAR_MONTH}, {_ACTIVE} FROM fact GROUP BY ALL"""
    ),
    "service_activity": query(
        """SELECT service_name, COUNT(DISTINCT pickup_date_key) AS operating_days,
          COUNT(DISTINCT vendor_id) AS active_vendors, COUNT(DISTINCT pickup_location_id) AS places_served
        FROM star GROUP BY ALL""",
        _STAR,
    ),
    "route_activity": query(
        f"SELECT {_ROUTE}, COUNT(DISTINCT pickup_date_key) AS active_days FROM star WHERE {_LOCATED} GROUP BY ALL",
        _STAR,
    ),
    "vendor_activity": query(
        """SELECT vendor_name, service_name, year, month, COUNT(DISTINCT pickup_date_key) AS operating_days,
          COUNT(DISTINCT pickup_location_id) AS coverage_locations
        FROM star WHERE vendor_id > 0 GROUP BY ALL""",
        _STAR,
    ),
    "revenue_quantiles": query(_quantiles(_SLOTS), _CENTS),
    "service_revenue_quantiles": query(f"SELECT *, {_MIDDLES} FROM ({_quantiles('file_type')})", _CENTS),
    "revenue_quantile_error": query(
        f"""SELECT file_type, count(*) AS slots, {_ERRORS} FROM (
          SELECT file_type, n, {_RANKS}
          FROM cents JOIN (SELECT {_SLOTS}, n, {_ESTIMATES} FROM ({_quantiles(_SLOTS)})) USING ({_SLOTS})
          GROUP BY {_SLOTS}, n)
        GROUP BY file_type""",
        _CENTS,
    ),
    "delta_upkeep_daily": query("SELECT * FROM daily", _LEFT, _DAILY.replace("FROM fact", "FROM left_over")),
    "delta_upkeep_hourly": query("SELECT * FROM hourly", _LEFT, _HOURLY.replace("FROM fact", "FROM left_over")),
    "stream_delta_fact": query(
        """SELECT pickup_date_key, pickup_time_key, file_type, vendor_id, CAST(total_amount AS DOUBLE) AS total_amount,
          source_year, source_month FROM left_over""",
        _LEFT,
    ),
    "fact_trips_incremental_bucketed": FACT_CHECKS["fact_trips_incremental"],
    "merge_upsert_bucketed": OPERATION_CHECKS["merge_upsert"],
    "trip_revenue_ranks": query(
        """SELECT file_type, pickup_date_key, pickup_time_key, CAST(total_amount AS DOUBLE) AS total_amount,
          RANK() OVER w AS rank, DENSE_RANK() OVER w AS dense_rank
        FROM fact WINDOW w AS (PARTITION BY file_type ORDER BY total_amount DESC NULLS LAST)"""
    ),
    "route_day_numbers": query(
        """SELECT *, ROW_NUMBER() OVER (ORDER BY date_key, pickup_location_id, dropoff_location_id) AS number,
          RANK() OVER (ORDER BY trips DESC) AS rank, DENSE_RANK() OVER (ORDER BY trips DESC) AS dense_rank
        FROM (SELECT pickup_date_key AS date_key, pickup_location_id, dropoff_location_id, COUNT(*) AS trips
          FROM fact GROUP BY ALL)"""
    ),
    "reconcile_contents": query(
        f"""SELECT {', '.join(_MONTHLY)}, COUNT(*) AS source_rows, COUNT(*) AS stored_rows,
          COUNT(*) FILTER (WHERE month = 3 AND vendor_id = 2 AND total_amount IS NOT NULL) = 0 AS same_content
        FROM trips GROUP BY ALL"""
    ),
    "clustered_place_month": query(
        """SELECT 'place' AS filtered_by, file_type, COUNT(*) AS trips, CAST(SUM(total_amount) AS DOUBLE) AS revenue
        FROM fact WHERE pickup_location_id = 4 GROUP BY ALL
        UNION ALL SELECT 'month', file_type, COUNT(*), CAST(SUM(total_amount) AS DOUBLE)
        FROM fact WHERE pickup_date_key // 100 = 199706 GROUP BY ALL"""
    ),
    "place_activity_supplied": query(
        """SELECT borough, zone_name, file_type, COUNT(*) AS trips, CAST(SUM(total_amount) AS DOUBLE) AS revenue
        FROM fact LEFT JOIN dim_location ON location_id = pickup_location_id GROUP BY ALL"""
    ),
    "stream_dedupe_state": query(
        """SELECT trip_id, CAST(strftime(pickup_datetime, '%Y%m%d') AS INTEGER) AS pickup_date_key,
          CAST(strftime(pickup_datetime, '%H%M') AS INTEGER) AS pickup_time_key
        FROM (SELECT DISTINCT trip_id, pickup_datetime FROM trips WHERE pickup_datetime IS NOT NULL)"""
    ),
}
