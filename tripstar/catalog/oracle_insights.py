"""Checks of the second-level analyses, each over its mart as table ``m``."""

from __future__ import annotations

from tripstar.catalog.oracle_base import percent
from tripstar.catalog.oracle_marts import on_mart

_DAY = """CASE day_name WHEN 'Mon' THEN 'Monday' WHEN 'Tue' THEN 'Tuesday'
  WHEN 'Wed' THEN 'Wednesday' WHEN 'Thu' THEN 'Thursday' WHEN 'Fri' THEN 'Friday'
  WHEN 'Sat' THEN 'Saturday' WHEN 'Sun' THEN 'Sunday' ELSE day_name END"""
_WEEK = """(VALUES ('Monday'), ('Tuesday'), ('Wednesday'), ('Thursday'), ('Friday'),
  ('Saturday'), ('Sunday')) AS w(day_name)"""


def _avg(column: str, digits: int = 6) -> str:
    return f"ROUND(AVG({column}), {digits})"


def _bigint_sum(column: str) -> str:
    return f"CAST(SUM({column}) AS BIGINT)"


def _bands(value: str, high: int, middle: int, names: list[str]) -> str:
    return (
        f"CASE WHEN {value} >= {high} THEN '{names[0]}' WHEN {value} >= {middle} "
        f"THEN '{names[1]}' ELSE '{names[2]}' END"
    )


def _demand(value: str) -> str:
    return _bands(value, 80, 50, ["Peak Hours", "High Demand", "Low Demand"])


def _sign(value: str) -> str:
    return (
        f"CASE WHEN {value} IS NULL THEN 'No Data' WHEN {value} > 0 THEN 'Growth' "
        f"WHEN {value} < 0 THEN 'Decline' ELSE 'Stable' END"
    )


_PIVOT_HOURS = ", ".join(
    f"ROUND(ifnull(AVG(demand_intensity) FILTER (WHERE hour = {h}), 0), 6) AS h{h:02d}"
    for h in range(24)
)
_NAMED = f"named AS (SELECT * REPLACE ({_DAY} AS day_name) FROM m)"

_HEATMAP = {
    "heatmap_overall_pivot": f"""SELECT w.day_name, {_PIVOT_HOURS} FROM {_WEEK}
      LEFT JOIN named n ON n.day_name = w.day_name GROUP BY w.day_name""",
    "heatmap_service_pivot": f"""SELECT s.service_name, w.day_name, {_PIVOT_HOURS}
      FROM (SELECT DISTINCT service_name FROM m) AS s CROSS JOIN {_WEEK}
      LEFT JOIN named n ON n.day_name = w.day_name AND n.service_name = s.service_name
      GROUP BY s.service_name, w.day_name""",
    "hourly_pattern": f"""SELECT hour, service_name, {_bigint_sum("trip_count")} AS trip_count,
      {_avg("avg_revenue")} AS avg_revenue FROM m GROUP BY ALL""",
    "daily_pattern": f"""SELECT day_name, day_of_week, service_name,
      {_bigint_sum("trip_count")} AS trip_count, {_avg("avg_revenue")} AS avg_revenue
      FROM named GROUP BY ALL""",
    "peak_insights": """
      (SELECT 'peak_hour' AS insight, 'all' AS scope, printf('%02d', hour) AS label,
         CAST(SUM(trip_count) AS BIGINT) AS trips
       FROM m GROUP BY hour ORDER BY 4 DESC, hour LIMIT 1)
      UNION ALL
      (SELECT 'peak_day', 'all', day_name, CAST(SUM(trip_count) AS BIGINT)
       FROM named GROUP BY day_name, day_of_week ORDER BY 4 DESC, day_of_week LIMIT 1)
      UNION ALL
      (SELECT 'service_peak_hour', service_name, printf('%02d', hour),
         CAST(SUM(trip_count) AS BIGINT)
       FROM m GROUP BY service_name, hour
       QUALIFY ROW_NUMBER() OVER (PARTITION BY service_name
         ORDER BY SUM(trip_count) DESC, hour) = 1)""",
    "heatmap_coverage": f"""SELECT COUNT(DISTINCT hour) AS hours_covered,
      COUNT(DISTINCT day_name) AS days_covered, {_avg("demand_intensity")} AS avg_intensity
      FROM m""",
    "top_hours_per_service": f"""SELECT h.*, {_demand("intensity")} AS band, t.* EXCLUDE (service_name)
      FROM (SELECT service_name, CAST(ROW_NUMBER() OVER (PARTITION BY service_name
          ORDER BY {_avg("demand_intensity")} DESC, hour) AS INTEGER) AS position, hour,
          {_avg("demand_intensity")} AS intensity FROM m GROUP BY service_name, hour) AS h
      JOIN (SELECT service_name, {_bigint_sum("trip_count")} AS total_trips,
          {_avg("avg_revenue")} AS avg_revenue, MAX(demand_intensity) AS max_intensity
          FROM m GROUP BY service_name) AS t ON t.service_name = h.service_name
      WHERE h.position <= 3""",
    "rush_totals": f"""SELECT
      {_bigint_sum("CASE WHEN hour >= 6 AND hour <= 10 THEN trip_count ELSE 0 END")}
        AS morning_trips,
      {_bigint_sum("CASE WHEN hour >= 17 AND hour <= 21 THEN trip_count ELSE 0 END")}
        AS evening_trips FROM m""",
    "weekday_weekend": f"""SELECT
      (SELECT {_bigint_sum("trip_count")} FROM m WHERE day_name NOT IN ('Sat', 'Sun'))
        AS weekday_trips,
      (SELECT {_bigint_sum("trip_count")} FROM m WHERE day_name IN ('Sat', 'Sun'))
        AS weekend_trips,
      p.* FROM (SELECT day_name AS peak_day, {_bigint_sum("trip_count")} AS peak_day_trips
        FROM named GROUP BY day_name, day_of_week ORDER BY 2 DESC, day_of_week LIMIT 1) AS p""",
    "high_value_slots": """SELECT ROUND(q, 6) AS revenue_quartile,
      (SELECT ROUND(AVG(avg_revenue), 6) FROM m WHERE avg_revenue > q) AS high_revenue_mean,
      (SELECT ROUND(AVG(avg_revenue), 6) FROM m WHERE demand_intensity > 70)
        AS high_demand_mean
      FROM (SELECT quantile_cont(avg_revenue, 0.75) AS q FROM m) AS s""",
    "period_analysis": f"""SELECT *, {_demand("demand_intensity")} AS band FROM (
      SELECT CASE WHEN hour < 5 OR hour >= 22 THEN 'Night (22-5)'
          WHEN hour < 12 THEN 'Morning (5-12)' WHEN hour < 17 THEN 'Afternoon (12-17)'
          ELSE 'Evening (17-22)' END AS time_period,
        {_bigint_sum("trip_count")} AS trip_count, {_avg("avg_revenue")} AS avg_revenue,
        {_avg("demand_intensity")} AS demand_intensity FROM m GROUP BY 1) AS s""",
}

_ROUTE = "pickup_borough, pickup_zone, dropoff_borough, dropoff_zone, service_name"
_ARROW = "pickup_zone || ' → ' || dropoff_zone"
_METRICS = ["trip_count", "total_revenue", "avg_revenue", "avg_distance", "avg_duration"]


def _mark(rank: str) -> str:
    return (
        f"CASE {rank} WHEN 1 THEN 'gold' WHEN 2 THEN 'silver' WHEN 3 THEN 'bronze' "
        f"ELSE '#' || {rank} END"
    )


def _top(metric: str) -> str:
    return f"""(SELECT '{metric}' AS metric, {_ARROW} AS route_label, {_ROUTE},
      CAST({metric} AS DOUBLE) AS value, {_mark("route_rank_by_volume")} AS volume_mark,
      {_mark("route_rank_by_revenue")} AS revenue_mark
      FROM m ORDER BY {metric} DESC NULLS LAST, {_ROUTE} LIMIT 15)"""


def _efficient(measure: str, base: str) -> str:
    return f"""(SELECT '{measure}' AS measure, {_ROUTE},
      ROUND(avg_revenue / nullif({base}, 0), 6) AS value
      FROM m ORDER BY value DESC NULLS LAST, {_ROUTE} LIMIT 5)"""


_ROUTES = {
    "top_n_by_metric": " UNION ALL ".join(_top(metric) for metric in _METRICS),
    "borough_flow": f"""SELECT g.*, CAST(s.n AS INTEGER) AS source, CAST(t.n AS INTEGER) AS target
      FROM (SELECT pickup_borough, dropoff_borough, {_bigint_sum("trip_count")} AS trip_count,
          SUM(total_revenue) AS total_revenue FROM m GROUP BY ALL) AS g
      JOIN nodes s ON s.name = pickup_borough JOIN nodes t ON t.name = dropoff_borough""",
    "route_service_stats": f"""SELECT service_name, {_bigint_sum("trip_count")} AS trip_count,
      SUM(total_revenue) AS total_revenue, {_avg("avg_revenue", 2)} AS avg_revenue,
      {_avg("avg_distance", 2)} AS avg_distance, {_avg("avg_duration", 2)} AS avg_duration
      FROM m GROUP BY service_name""",
    "route_insights": f"""
      (SELECT 'busiest_route' AS insight, {_ARROW} AS label, CAST(trip_count AS DOUBLE) AS value,
         total_revenue AS other FROM m ORDER BY trip_count DESC, {_ROUTE} LIMIT 1)
      UNION ALL
      (SELECT 'most_profitable_route', {_ARROW}, total_revenue, CAST(trip_count AS DOUBLE)
       FROM m WHERE total_revenue IS NOT NULL ORDER BY total_revenue DESC, {_ROUTE} LIMIT 1)
      UNION ALL
      (SELECT 'top_pickup_borough', pickup_borough, CAST(SUM(trip_count) AS DOUBLE), NULL
       FROM m GROUP BY pickup_borough ORDER BY 3 DESC, 2 LIMIT 1)
      UNION ALL
      (SELECT 'dominant_service', service_name, CAST(COUNT(*) AS DOUBLE), NULL
       FROM m GROUP BY service_name ORDER BY 3 DESC, 2 LIMIT 1)""",
    "route_totals": f"""SELECT COUNT(*) AS total_routes, {_bigint_sum("trip_count")} AS total_trips,
      ROUND(SUM(total_revenue), 2) AS total_revenue,
      ROUND(SUM(total_revenue), 2) / COUNT(total_revenue) AS avg_route_revenue FROM m""",
    "borough_performance": f"""SELECT pickup_borough, {_bigint_sum("trip_count")} AS trip_count,
      ROUND(SUM(total_revenue), 2) AS total_revenue FROM m GROUP BY pickup_borough""",
    "route_efficiency": _efficient("revenue_per_mile", "avg_distance")
    + " UNION ALL "
    + _efficient("revenue_per_minute", "avg_duration"),
}
for _name in ("borough_flow", "route_service_stats"):
    _ROUTES[_name] = _ROUTES[_name].replace(
        "SUM(total_revenue) AS", "ROUND(SUM(total_revenue), 2) AS"
    )
_NODES = """nodes AS (SELECT name, ROW_NUMBER() OVER (ORDER BY name) - 1 AS n FROM
  (SELECT pickup_borough AS name FROM m UNION SELECT dropoff_borough FROM m) AS b)"""

_TOTAL = f"{_bigint_sum('trip_count')} AS trip_count, ROUND(SUM(total_revenue), 2) AS total_revenue"
_FROM = "SUM(CASE WHEN trip_type = 'From Airport' THEN trip_count ELSE 0 END)"
_TO = "SUM(CASE WHEN trip_type = 'To Airport' THEN trip_count ELSE 0 END)"
_MONTH_NO = (
    "CAST(list_position(['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'],"
    " month_name) AS INTEGER)"
)

_AIRPORTS = {
    "airport_headline": f"""SELECT {_bigint_sum("trip_count")} AS total_trips,
      ROUND(SUM(total_revenue), 2) AS total_revenue, {_avg("avg_fare")} AS avg_fare,
      COUNT(DISTINCT airport_name) AS airports_served,
      CAST({_FROM} AS BIGINT) AS from_trips, CAST({_TO} AS BIGINT) AS to_trips,
      {percent(_FROM, "SUM(trip_count)")} AS from_pct,
      {percent(_TO, "SUM(trip_count)")} AS to_pct FROM m""",
    "airport_direction": f"""SELECT airport_name, trip_type, {_TOTAL}, {_avg("avg_fare")} AS avg_fare
      FROM m GROUP BY airport_name, trip_type""",
    "airport_performance": f"""SELECT *, {_bands("trip_count", 10000, 5000,
        ["High Traffic", "Medium Traffic", "Low Traffic"])} AS band FROM (
      SELECT airport_name, {_TOTAL}, {_avg("avg_fare", 2)} AS avg_fare,
        {_avg("avg_distance", 2)} AS avg_distance, {_avg("avg_duration", 2)} AS avg_duration,
        CAST({_FROM} AS BIGINT) AS from_trips, CAST({_TO} AS BIGINT) AS to_trips
      FROM m GROUP BY airport_name) AS s""",
    "airport_time_patterns": f"""SELECT time_period, trip_type,
        {_bigint_sum("trip_count")} AS trip_count, {_avg("avg_fare")} AS avg_fare
      FROM m GROUP BY ALL
      UNION ALL SELECT time_period, 'All', {_bigint_sum("trip_count")}, {_avg("avg_fare")}
      FROM m GROUP BY time_period""",
    "airport_service_share": f"""SELECT s.*,
        {percent("trip_count", "(SELECT SUM(trip_count) FROM m)")} AS share_pct FROM (
      SELECT service_name, {_TOTAL}, {_avg("avg_fare", 2)} AS avg_fare,
        {_avg("avg_distance", 2)} AS avg_distance FROM m GROUP BY service_name) AS s""",
    "airport_recent_months": f"""SELECT year, {_MONTH_NO} AS month,
        year || ' - ' || month_name AS period, {_TOTAL}, {_avg("avg_fare")} AS avg_fare
      FROM m GROUP BY year, month_name ORDER BY year DESC, month DESC LIMIT 6""",
}

_GROWN = "FROM m WHERE trips_mom_growth IS NOT NULL AND revenue_mom_growth IS NOT NULL"


def _extreme(kind: str, metric: str, direction: str) -> str:
    return f"""(SELECT '{kind}' AS insight, service_name, year, month_name, {metric} AS growth
      {_GROWN} ORDER BY {metric} {direction}, year, month, service_name LIMIT 1)"""


_TRENDS = {
    "trend_summary": f"""SELECT COUNT(*) AS data_points, COUNT(DISTINCT service_name) AS services,
      MIN(year) AS first_year, MAX(year) AS last_year,
      {_avg("trips_mom_growth")} AS avg_trip_growth,
      {_avg("revenue_mom_growth")} AS avg_revenue_growth FROM m""",
    "trend_series": f"""SELECT service_name, year, month, month_name || ' ' || year AS month_label,
      trip_count, total_revenue, avg_revenue_per_trip,
      {_sign("trips_mom_growth")} AS trip_growth_sign,
      {_sign("revenue_mom_growth")} AS revenue_growth_sign FROM m""",
    "trend_extremes": " UNION ALL ".join(
        [
            _extreme("best_trip_growth", "trips_mom_growth", "DESC"),
            _extreme("best_revenue_growth", "revenue_mom_growth", "DESC"),
            _extreme("worst_trip_growth", "trips_mom_growth", "ASC"),
            _extreme("worst_revenue_growth", "revenue_mom_growth", "ASC"),
        ]
    ),
    "trend_service_performance": "SELECT service_name, "
    + ", ".join(
        f"{_avg(c, 2)} AS {c}"
        for c in ("trip_count", "total_revenue", "avg_revenue_per_trip", "trips_mom_growth",
                  "revenue_mom_growth")
    )
    + " FROM m GROUP BY service_name",
}


def _guarded(top: str, bottom: str) -> str:
    return f"CASE WHEN {bottom} > 0 THEN ROUND({top} / ({bottom}), 6) ELSE 0 END"


_PACE = _guarded("avg_distance * 60", "avg_duration")
_DENSITY = _guarded("CAST(total_passengers AS DOUBLE)", "total_trips")
_HEADLINES = {
    "executive_ratios": f"""SELECT {_DENSITY} AS passengers_per_trip, {_PACE} AS avg_speed,
      {_guarded("total_revenue", "total_passengers")} AS revenue_per_passenger,
      {_guarded("total_revenue", "total_trips * avg_distance")} AS revenue_per_mile,
      ROUND(CAST(total_trips AS DOUBLE) / 90, 6) AS trips_per_day,
      ROUND(total_trips / nullif(1 + trips_growth_pct / 100, 0), 6) AS previous_trips,
      ROUND(total_revenue / nullif(1 + revenue_growth_pct / 100, 0), 6) AS previous_revenue
      FROM m""",
    "executive_insights": f"""SELECT period, concat_ws(',',
      CASE WHEN trips_growth_pct IS NULL OR revenue_growth_pct IS NULL THEN NULL
        WHEN trips_growth_pct > 0 AND revenue_growth_pct > 0 THEN 'strong_growth'
        WHEN trips_growth_pct > 0 AND revenue_growth_pct < 0 THEN 'volume_up_revenue_down'
        WHEN trips_growth_pct < 0 AND revenue_growth_pct > 0 THEN 'volume_down_revenue_up'
        ELSE 'declining' END,
      CASE WHEN avg_trip_value > 25 THEN 'premium_value'
        WHEN avg_trip_value < 15 THEN 'low_value' END,
      CASE WHEN {_DENSITY} > 1.5 THEN 'good_density' END,
      CASE WHEN {_PACE} > 15 THEN 'good_speed' WHEN {_PACE} < 10 THEN 'low_speed' END
      ) AS insights FROM m""",
}
_COMPARISON = {
    "service_share": f"""SELECT service_name, service_category, total_trips, total_revenue,
      {percent("CAST(total_revenue AS DECIMAL(20,2))",
               "(SELECT SUM(CAST(total_revenue AS DECIMAL(20,2))) FROM m)", 100)}
        AS revenue_share_pct,
      {percent("total_trips", "(SELECT SUM(total_trips) FROM m)")} AS trip_share_pct,
      (SELECT {_avg("avg_tip_percentage")} FROM m) AS mean_tip_percentage FROM m""",
    "service_bands": f"""SELECT service_name, service_category, cashless_percentage,
      {_bands("cashless_percentage", 80, 50, ["High Digital", "Mixed Payment", "Cash Heavy"])}
        AS cashless_band,
      CASE WHEN regexp_matches(lower(service_category), 'premium|luxury|executive')
          THEN 'premium-service'
        WHEN regexp_matches(lower(service_category), 'standard|regular|normal')
          THEN 'standard-service' ELSE 'economy-service' END AS service_class FROM m""",
}

INSIGHT_CHECKS = {
    **{name: on_mart("hourly_demand_heatmap", sql, _NAMED) for name, sql in _HEATMAP.items()},
    **{name: on_mart("top_routes", sql, _NODES) for name, sql in _ROUTES.items()},
    **{name: on_mart("airport_traffic", sql) for name, sql in _AIRPORTS.items()},
    **{name: on_mart("monthly_trends", sql) for name, sql in _TRENDS.items()},
    **{name: on_mart("executive_kpis", sql) for name, sql in _HEADLINES.items()},
    **{name: on_mart("service_comparison", sql) for name, sql in _COMPARISON.items()},
    "export_csv_roundtrip": on_mart("monthly_trends", "SELECT * FROM m"),
}
