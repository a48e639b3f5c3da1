"""Checks of the facts, summaries, dimensions and marts."""

from __future__ import annotations

from tripstar.catalog.oracle_base import (
    AS_OF,
    CALENDAR_COLUMNS,
    CLOCK_COLUMNS,
    MONEY,
    SPEED,
    TIP,
    as_double,
    days,
    mean,
    money,
    percent,
    query,
    ratio_mean,
)

_AVG = {
    "revenue": mean("f.total_amount"),
    "distance": mean("f.trip_distance"),
    "duration": mean("f.trip_duration_minutes"),
    "passengers": mean("f.passenger_count"),
}
_REVENUE = money("SUM(f.total_amount)")


def _usage(dim: str, key: str, **roles: str) -> str:
    counts = "".join(
        f", (SELECT COUNT(*) FROM fact f WHERE f.{column} = m.{key}) AS {name}"
        for name, column in roles.items()
    )
    return f"SELECT m.*{counts} FROM {dim} m"


_DAILY = f"""daily AS (
  SELECT pickup_date_key AS date_key, pickup_location_id, dropoff_location_id, file_type,
    vendor_id, COUNT(*) AS total_trips,
    CAST(SUM(passenger_count) AS BIGINT) AS total_passengers,
    {money("SUM(trip_distance)")} AS total_distance,
    {money("SUM(total_amount)")} AS total_revenue, {money("SUM(tip_amount)")} AS total_tips,
    {mean("trip_distance")} AS avg_trip_distance, {mean("fare_amount")} AS avg_fare_amount,
    CASE WHEN SUM(fare_amount) > 0 THEN CAST(SUM(tip_amount) AS DOUBLE)
      / CAST(SUM(fare_amount) AS DOUBLE) * 100 ELSE 0 END AS avg_tip_percentage,
    {mean("trip_duration_minutes")} AS avg_trip_duration_minutes
  FROM fact GROUP BY ALL)"""

_HOURLY = f"""hourly AS (
  SELECT pickup_date_key AS date_key,
    CAST(pickup_time_key // 100 * 100 AS INTEGER) AS time_key, file_type, pickup_location_id,
    COUNT(*) AS total_trips, CAST(SUM(passenger_count) AS BIGINT) AS total_passengers,
    {money("SUM(trip_distance)")} AS total_distance,
    {money("SUM(total_amount)")} AS total_revenue,
    {mean("trip_distance")} AS avg_trip_distance, {mean("fare_amount")} AS avg_fare_amount
  FROM fact GROUP BY ALL)"""

_MINUTES = "(epoch_us(dropoff_datetime) - epoch_us(pickup_datetime))"
_MEAN_MINUTES = f"{mean(_MINUTES)} / 60000000"


def _mean2(column: str, unit: str, scale: int) -> str:
    """Mean of non-negative values to two places, half up, on integers."""
    total, base = f"CAST(SUM({column}) * {scale} AS HUGEINT)", f"(COUNT({column}) * {unit})"
    return f"CAST(({total} * 2 + {base}) // (2 * {base}) AS DOUBLE) / 100"


_ROUNDED = {
    "distance": _mean2("trip_distance", "1", 100),
    "minutes": _mean2(_MINUTES, "60000000", 100),
}
_PLAIN = {"distance": mean("trip_distance"), "minutes": _MEAN_MINUTES}


def _summary(year: str, month: str, averages: dict[str, str]) -> str:
    return f"""SELECT {year} AS year, {month} AS month, file_type, COUNT(*) AS total_trips,
      CAST(SUM(passenger_count) AS BIGINT) AS total_passengers,
      {averages["distance"]} AS avg_trip_distance,
      {averages["minutes"]} AS avg_trip_time,
      {money("SUM(fare_amount)")} AS total_fare, {money("SUM(tip_amount)")} AS total_tips,
      {money("SUM(total_amount)")} AS total_amount
    FROM trips GROUP BY ALL"""


_FARES = f"""SELECT year, month, file_type, {money("SUM(fare_amount)")} AS total_fare,
    {money("SUM(tip_amount)")} AS total_tips, {money("SUM(tolls_amount)")} AS total_tolls,
    {money("SUM(mta_tax + airport_fee + improvement_surcharge + congestion_surcharge)")}
      AS total_surcharges,
    {money("SUM(total_amount)")} AS total_amount
  FROM trips GROUP BY ALL"""


def _locations(where: str) -> str:
    return f"""SELECT year, month, file_type, pu_location_id AS pickup_location_id,
      do_location_id AS dropoff_location_id, COUNT(*) AS total_trips,
      {_ROUNDED["distance"]} AS avg_trip_distance,
      {_ROUNDED["minutes"]} AS avg_trip_time, {money("SUM(total_amount)")} AS total_amount
    FROM trips {where} GROUP BY ALL"""


_KNOWN = "WHERE pu_location_id IS NOT NULL AND do_location_id IS NOT NULL"


def _hundredths(column: str) -> str:
    return f"CAST({column} * 100 AS BIGINT)"


def _round2(top: str, bottom: str) -> str:
    """Non-negative quotient of integers, in hundredths, half up."""
    return f"CAST(({top} * 2 + {bottom}) // (2 * {bottom}) AS DOUBLE) / 100"


_TIP_PCT = (
    "CASE WHEN fare_amount > 0 THEN "
    + _round2(f"{_hundredths('tip_amount')} * 10000", _hundredths("fare_amount"))
    + " ELSE 0 END"
)
_MPH = (
    "CASE WHEN trip_duration_minutes > 0 THEN "
    + _round2(f"{_hundredths('trip_distance')} * 60", "trip_duration_minutes")
    + " ELSE 0 END"
)
_PER_MILE = (
    "CASE WHEN trip_distance > 0 THEN "
    + _round2(f"{_hundredths('total_amount')} * 100", _hundredths("trip_distance"))
    + " ELSE 0 END"
)
_DERIVED = (
    f"{_TIP_PCT} AS tip_percentage, {_MPH} AS avg_speed_mph, {_PER_MILE} AS revenue_per_mile"
)

FACT_CHECKS = {
    "fact_trips": query(f"SELECT * REPLACE ({as_double('trip_distance', *MONEY)}) FROM fact"),
    "fact_trips_incremental": query(
        f"""SELECT * REPLACE ({as_double('trip_distance', *MONEY)}) FROM fact
        WHERE trip_id NOT IN (SELECT trip_id FROM fact WHERE store_fwd_flag = 'Y')"""
    ),
    "trip_duration": query(
        "SELECT trip_id, pickup_date_key, pickup_time_key, trip_duration_minutes FROM fact"
    ),
    "trip_derived_measures": query(f"SELECT trip_id, {_DERIVED} FROM fact"),
    "fact_trips_daily_agg": query("SELECT * FROM daily", _DAILY),
    "fact_trips_hourly_agg": query("SELECT * FROM hourly", _HOURLY),
    "heatmap_from_hourly": query(
        """SELECT f.file_type, d.day_of_week, t.hour, COUNT(*) AS trip_count FROM fact f
        JOIN dim_date d ON d.date_key = f.pickup_date_key
        JOIN dim_time t ON t.time_key = f.pickup_time_key GROUP BY ALL"""
    ),
    "daily_to_monthly": query(
        f"""SELECT file_type, CAST(pickup_date_key // 10000 AS INTEGER) AS year,
          CAST(pickup_date_key // 100 % 100 AS INTEGER) AS month, COUNT(*) AS trip_count,
          CAST(SUM(passenger_count) AS BIGINT) AS total_passengers,
          {money("SUM(total_amount)")} AS total_revenue, {money("SUM(tip_amount)")} AS total_tips
        FROM fact GROUP BY ALL"""
    ),
    "fact_trip_summary": query(_summary("year", "month", _ROUNDED)),
    "trip_summary_by_event_month": query(
        _summary(
            "CAST(year(pickup_datetime) AS INTEGER)", "CAST(month(pickup_datetime) AS INTEGER)",
            _PLAIN,
        )
    ),
    "fact_fare_summary": query(_FARES),
    "fare_summary_preview": query(_FARES + " ORDER BY year, month, file_type LIMIT 20"),
    "fact_trip_locations": query(_locations(_KNOWN)),
    "trip_locations_top10": query(
        _locations("")
        + " ORDER BY year, month, total_trips DESC, file_type, pickup_location_id NULLS FIRST,"
        " dropoff_location_id NULLS FIRST LIMIT 10"
    ),
}

_BOUNDS = """SELECT MIN(CAST(pickup_datetime AS DATE)) AS first,
  MAX(CAST(pickup_datetime AS DATE)) AS last FROM trips"""

DIMENSION_CHECKS = {
    "dim_location": query(
        _usage("dim_location", "location_id", pickups="pickup_location_id",
               dropoffs="dropoff_location_id")
    ),
    "dim_vendor": query(_usage("dim_vendor", "vendor_id", trips="vendor_id")),
    "dim_payment_type": query(
        _usage("dim_payment_type", "payment_type_id", trips="payment_type_id")
    ),
    "dim_rate_code": query(
        _usage("dim_rate_code", "ratecode_id", trips="ratecode_id").replace(
            "m.*", "m.* REPLACE (CAST(m.multiplier AS DOUBLE) AS multiplier)"
        )
    ),
    "dim_trip_type": query(_usage("dim_trip_type", "trip_type_id", trips="trip_type_id")),
    "dim_file_source": query(_usage("dim_file_source", "file_type", trips="file_type")),
    "dim_store_fwd_flag": query(
        _usage("dim_store_fwd_flag", "store_fwd_flag", trips="store_fwd_flag")
    ),
    "dim_date": query(
        f"""SELECT c.*, COUNT(f.trip_id) AS trips FROM (SELECT {CALENDAR_COLUMNS} FROM
        ({days("(SELECT first FROM b)", "(SELECT last FROM b)")}) AS s) c
        LEFT JOIN fact f ON f.pickup_date_key = c.date_key GROUP BY ALL""",
        f"b AS ({_BOUNDS})",
    ),
    "dim_time": query(
        f"""SELECT c.*, COUNT(f.trip_id) AS trips FROM
        (SELECT {CLOCK_COLUMNS} FROM range(1440) AS r(m)) c
        LEFT JOIN fact f ON f.pickup_time_key = c.time_key GROUP BY ALL"""
    ),
    "dim_date_pg": query(
        f"""SELECT d AS date_id, CAST(year(d) AS INTEGER) AS year,
          CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
          CAST(isodow(d) AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name,
          strftime(d, '%B') AS month_name, CAST(quarter(d) AS INTEGER) AS quarter,
          isodow(d) > 5 AS is_weekend
        FROM ({days("(SELECT MIN(make_date(year, month, 1)) FROM trips)",
                    f"DATE '{AS_OF}'")}) AS s"""
    ),
    "dim_location_pg": query(
        f"""SELECT id AS location_id, CASE WHEN bool_or(p) THEN 'pickup' ELSE 'dropoff' END
          AS location_type, CAST(NULL AS VARCHAR) AS borough, CAST(NULL AS VARCHAR) AS zone
        FROM (SELECT pu_location_id AS id, TRUE AS p FROM trips {_KNOWN} UNION ALL
              SELECT do_location_id, FALSE FROM trips {_KNOWN}) AS e GROUP BY id"""
    ),
}

# ---------------------------------------------------------------------------
# Marts: one star-joined detail table, then plain grouping
# ---------------------------------------------------------------------------
_STAR = """star AS (
  SELECT f.*, s.service_name, s.service_category, d.full_date, d.year, d.month, d.month_name,
    d.quarter, d.day_of_week, d.day_name, d.is_weekend, t.hour, t.time_period, t.rush_hour_flag,
    pl.zone_name AS pickup_zone, pl.borough AS pickup_borough, pl.is_airport AS from_airport,
    dl.zone_name AS dropoff_zone, dl.borough AS dropoff_borough, dl.is_airport AS to_airport,
    v.vendor_name, v.vendor_category, p.payment_method, p.payment_category, p.is_cashless
  FROM fact f
  LEFT JOIN dim_file_source s USING (file_type)
  LEFT JOIN dim_date d ON d.date_key = f.pickup_date_key
  LEFT JOIN dim_time t ON t.time_key = f.pickup_time_key
  LEFT JOIN dim_location pl ON pl.location_id = f.pickup_location_id
  LEFT JOIN dim_location dl ON dl.location_id = f.dropoff_location_id
  LEFT JOIN dim_vendor v ON v.vendor_id = f.vendor_id
  LEFT JOIN dim_payment_type p ON p.payment_type_id = f.payment_type_id)"""

_ROUTE = "pickup_borough, pickup_zone, dropoff_borough, dropoff_zone, service_name"
_LOCATED = "pickup_zone IS NOT NULL AND dropoff_zone IS NOT NULL"

_MONTH = AS_OF.year * 100 + AS_OF.month
_PERIOD = f"""period AS (
  SELECT pickup_date_key // 100 = {_MONTH} AS now, * FROM fact
  WHERE pickup_date_key // 100 IN ({_MONTH}, {_MONTH - 1}))"""


def _tally(column: str, now: bool) -> str:
    return f"(SELECT {column} FROM period f WHERE {'now' if now else 'NOT now'})"


MART_SQL = {
    "revenue_analytics": f"""SELECT full_date, year, month, month_name, quarter, is_weekend,
        service_name, vendor_name, payment_method, COUNT(*) AS trip_count,
        {_REVENUE} AS total_revenue, {money("SUM(f.fare_amount)")} AS total_fares,
        {money("SUM(f.tip_amount)")} AS total_tips, {money("SUM(f.tolls_amount)")} AS total_tolls,
        {money("SUM(f.congestion_surcharge)")} AS total_congestion_charges,
        {_AVG["revenue"]} AS avg_trip_revenue, {mean("f.fare_amount")} AS avg_fare,
        {ratio_mean(TIP)} AS avg_tip_percentage,
        CAST(SUM(f.passenger_count) AS BIGINT) AS total_passengers,
        {_AVG["distance"]} AS avg_trip_distance, {_AVG["duration"]} AS avg_trip_duration
      FROM star f WHERE full_date IS NOT NULL GROUP BY ALL""",
    "location_performance": f"""SELECT {_ROUTE}, COUNT(*) AS trip_count,
        {_AVG["distance"]} AS avg_distance, {_AVG["duration"]} AS avg_duration,
        {_AVG["revenue"]} AS avg_revenue, {_REVENUE} AS total_revenue,
        {ratio_mean(SPEED)} AS avg_speed_mph,
        COUNT(DISTINCT pickup_date_key) AS active_days
      FROM star f WHERE {_LOCATED} GROUP BY ALL""",
    "time_patterns": f"""SELECT hour AS pickup_hour, time_period, rush_hour_flag, day_name,
        is_weekend, service_name, COUNT(*) AS trip_count, {_AVG["revenue"]} AS avg_revenue,
        {_AVG["distance"]} AS avg_distance, {_AVG["duration"]} AS avg_duration,
        {_AVG["passengers"]} AS avg_passengers, {_REVENUE} AS total_revenue,
        {ratio_mean(SPEED)} AS avg_speed_mph
      FROM star f GROUP BY ALL""",
    "payment_behavior": f"""SELECT payment_method, payment_category, is_cashless, service_name,
        year, month_name, COUNT(*) AS trip_count, {_AVG["revenue"]} AS avg_total_amount,
        {mean("f.tip_amount")} AS avg_tip_amount, {ratio_mean(TIP)} AS avg_tip_percentage,
        {_REVENUE} AS total_revenue, {money("SUM(f.tip_amount)")} AS total_tips,
        COUNT(*) FILTER (WHERE f.tip_amount > 0) AS trips_with_tips,
        {percent("COUNT(*) FILTER (WHERE f.tip_amount > 0)", "COUNT(*)")}
          AS tip_frequency_percentage
      FROM star f GROUP BY ALL""",
    "executive_kpis": f"""SELECT 'Current Month' AS period, {_tally("COUNT(*)", True)} AS total_trips,
        {_tally(_REVENUE, True)} AS total_revenue, {_tally(_AVG["revenue"], True)} AS avg_trip_value,
        {_tally("CAST(SUM(passenger_count) AS BIGINT)", True)} AS total_passengers,
        {_tally(_AVG["distance"], True)} AS avg_distance,
        {_tally(_AVG["duration"], True)} AS avg_duration,
        {percent(f"{_tally('COUNT(*)', True)} - {_tally('COUNT(*)', False)}",
                 _tally("COUNT(*)", False))} AS trips_growth_pct,
        {percent(f"{_tally('SUM(total_amount)', True)} - {_tally('SUM(total_amount)', False)}",
                 _tally("SUM(total_amount)", False), 100)} AS revenue_growth_pct""",
    "service_comparison": f"""SELECT service_name, service_category, COUNT(*) AS total_trips,
        {_REVENUE} AS total_revenue, {_AVG["revenue"]} AS avg_revenue_per_trip,
        {_AVG["distance"]} AS avg_trip_distance, {_AVG["duration"]} AS avg_trip_duration,
        {_AVG["passengers"]} AS avg_passengers, {ratio_mean(TIP)} AS avg_tip_percentage,
        COUNT(*) FILTER (WHERE is_cashless) AS cashless_trips,
        {percent("COUNT(*) FILTER (WHERE is_cashless)", "COUNT(*)")} AS cashless_percentage,
        COUNT(DISTINCT pickup_date_key) AS operating_days,
        COUNT(DISTINCT vendor_id) AS active_vendors
      FROM star f GROUP BY ALL""",
    "hourly_demand_heatmap": f"""SELECT g.* EXCLUDE (busiest),
        {percent("trip_count", "busiest")} AS demand_intensity FROM (
        SELECT *, MAX(trip_count) OVER (PARTITION BY service_name) AS busiest FROM (
          SELECT day_name, day_of_week, hour, service_name, COUNT(*) AS trip_count,
            {_AVG["revenue"]} AS avg_revenue FROM star f GROUP BY ALL) AS s) AS g""",
    "top_routes": f"""SELECT *,
        CAST(RANK() OVER (PARTITION BY service_name ORDER BY trip_count DESC) AS INTEGER)
          AS route_rank_by_volume,
        CAST(RANK() OVER (PARTITION BY service_name ORDER BY total_revenue DESC NULLS FIRST)
          AS INTEGER) AS route_rank_by_revenue
      FROM (SELECT {_ROUTE}, COUNT(*) AS trip_count, {_REVENUE} AS total_revenue,
          {_AVG["revenue"]} AS avg_revenue, {_AVG["distance"]} AS avg_distance,
          {_AVG["duration"]} AS avg_duration
        FROM star f WHERE {_LOCATED} AND pickup_location_id > 0 AND dropoff_location_id > 0
        GROUP BY ALL) AS g
      WHERE trip_count > 100 ORDER BY trip_count DESC, {_ROUTE} LIMIT 100""",
    "monthly_trends": f"""SELECT g.* EXCLUDE (revenue, prev_revenue),
        CAST(prev_revenue AS DOUBLE) AS prev_month_revenue,
        {percent("trip_count - prev_month_trips", "prev_month_trips")} AS trips_mom_growth,
        {percent("revenue - prev_revenue", "prev_revenue", 100)} AS revenue_mom_growth
      FROM (SELECT *, lag(trip_count) OVER m AS prev_month_trips,
          lag(revenue) OVER m AS prev_revenue FROM (
          SELECT year, month, month_name, service_name, COUNT(*) AS trip_count,
            SUM(f.total_amount) AS revenue, {_REVENUE} AS total_revenue,
            {_AVG["revenue"]} AS avg_revenue_per_trip,
            CAST(SUM(f.passenger_count) AS BIGINT) AS total_passengers,
            {_AVG["distance"]} AS avg_distance FROM star f GROUP BY ALL) AS s
        WINDOW m AS (PARTITION BY service_name ORDER BY year * 12 + month)) AS g""",
    "airport_traffic": f"""SELECT
        CASE WHEN from_airport THEN 'From Airport' ELSE 'To Airport' END AS trip_type,
        CASE WHEN from_airport THEN pickup_zone ELSE dropoff_zone END AS airport_name,
        service_name, year, month_name, time_period, COUNT(*) AS trip_count,
        {_AVG["revenue"]} AS avg_fare, {_AVG["distance"]} AS avg_distance,
        {_AVG["duration"]} AS avg_duration, {_REVENUE} AS total_revenue
      FROM star f WHERE {_LOCATED} AND (from_airport OR to_airport) GROUP BY ALL""",
    "vendor_performance": f"""SELECT g.* EXCLUDE (whole),
        {percent("trip_count", "whole")} AS market_share_pct FROM (
        SELECT *, SUM(trip_count) OVER (PARTITION BY service_name, year, month_name) AS whole
        FROM (SELECT vendor_name, vendor_category, service_name, year, month_name,
          COUNT(*) AS trip_count, {_REVENUE} AS total_revenue,
          {_AVG["revenue"]} AS avg_revenue_per_trip, {_AVG["distance"]} AS avg_trip_distance,
          {_AVG["duration"]} AS avg_trip_duration, {ratio_mean(TIP)} AS avg_tip_percentage,
          COUNT(DISTINCT pickup_date_key) AS operating_days,
          COUNT(DISTINCT pickup_location_id) AS coverage_locations
        FROM star f WHERE vendor_id > 0 GROUP BY ALL) AS s) AS g""",
    "rush_hour_analysis": f"""SELECT rush_hour_flag,
        CASE WHEN rush_hour_flag THEN 'Rush Hour' ELSE 'Non-Rush Hour' END AS period_type,
        is_weekend, service_name, COUNT(*) AS trip_count, {_AVG["revenue"]} AS avg_fare,
        {_AVG["distance"]} AS avg_distance, {_AVG["duration"]} AS avg_duration,
        {ratio_mean(SPEED)} AS avg_speed_mph, {_AVG["passengers"]} AS avg_passengers,
        {_REVENUE} AS total_revenue
      FROM star f GROUP BY ALL""",
}
MART_CHECKS = {name: query(sql, _STAR, _PERIOD) for name, sql in MART_SQL.items()}

_WIDE_MONEY = [c for c in MONEY if c != "ehail_fee"]
MART_CHECKS["trip_analytics"] = query(
    f"""SELECT f.trip_id, f.file_type, s.service_name, s.service_category,
      d.full_date AS pickup_date, d.year AS pickup_year, d.month AS pickup_month,
      d.month_name AS pickup_month_name, d.quarter AS pickup_quarter,
      d.day_of_week AS pickup_day_of_week, d.day_name AS pickup_day_name,
      d.is_weekend AS pickup_is_weekend, d.week_of_year AS pickup_week,
      t.hour AS pickup_hour, t.hour_minute AS pickup_time, t.time_period AS pickup_time_period,
      t.rush_hour_flag AS pickup_is_rush_hour,
      t.business_hours_flag AS pickup_is_business_hours,
      a.location_id AS pickup_location_id, a.zone_name AS pickup_zone,
      a.borough AS pickup_borough, a.is_airport AS pickup_is_airport,
      a.is_manhattan AS pickup_is_manhattan,
      b.location_id AS dropoff_location_id, b.zone_name AS dropoff_zone,
      b.borough AS dropoff_borough, b.is_airport AS dropoff_is_airport,
      b.is_manhattan AS dropoff_is_manhattan,
      v.vendor_name, v.vendor_category, p.payment_method, p.payment_category, p.is_cashless,
      r.rate_description, r.rate_category, r.is_airport_rate, y.trip_description,
      w.flag_description AS store_forward_status, f.passenger_count,
      CAST(f.trip_distance AS DOUBLE) AS trip_distance, f.trip_duration_minutes,
      {", ".join(f"CAST(f.{c} AS DOUBLE) AS {c}" for c in _WIDE_MONEY)}, {_DERIVED},
      f.dispatching_base_num, f.affiliated_base_number, f.sr_flag
    FROM fact f
    LEFT JOIN dim_date d ON d.date_key = f.pickup_date_key
    LEFT JOIN dim_time t ON t.time_key = f.pickup_time_key
    LEFT JOIN dim_location a ON a.location_id = f.pickup_location_id
    LEFT JOIN dim_location b ON b.location_id = f.dropoff_location_id
    LEFT JOIN dim_file_source s ON s.file_type = f.file_type
    LEFT JOIN dim_vendor v ON v.vendor_id = f.vendor_id
    LEFT JOIN dim_payment_type p ON p.payment_type_id = f.payment_type_id
    LEFT JOIN dim_rate_code r ON r.ratecode_id = f.ratecode_id
    LEFT JOIN dim_trip_type y ON y.trip_type_id = f.trip_type_id
    LEFT JOIN dim_store_fwd_flag w ON w.store_fwd_flag = f.store_fwd_flag"""
)


def on_mart(mart: str, body: str, *ctes: str) -> str:
    """A check of an analysis of one mart, available as table ``m``."""
    return query(body, _STAR, _PERIOD, f"m AS ({MART_SQL[mart]})", *ctes)
