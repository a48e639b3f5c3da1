"""Registered analytics: facts, dimensions, marts and second-level analyses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.catalog import stored
from tripstar.catalog.oracle_base import AS_OF
from tripstar.operators import facts, summaries
from tripstar.plans import airports, headlines, heatmap, marts, routes, trends
from tripstar.session import scratch_dir
from tripstar.sources import dimensions, exports

Query = Callable[[SparkSession, str], DataFrame]


def _mart(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = stored.star(spark, sf_dir)
        if name == "executive_kpis":
            return marts.executive_kpis(tables, AS_OF)
        return marts.MARTS[name](tables)

    return run


def _over(mart: str, analysis: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: analysis(_mart(mart)(spark, sf_dir))


def _on_fact(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(stored.fact(spark, sf_dir))


def _on_trips(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(stored.trips(spark, sf_dir))


def _incremental(fact: DataFrame) -> DataFrame:
    loaded = fact.filter(F.col("store_fwd_flag") == "Y")
    return facts.not_yet_loaded(fact, loaded)


def _durations(fact: DataFrame) -> DataFrame:
    return fact.select(
        "trip_id", "pickup_date_key", "pickup_time_key", "trip_duration_minutes"
    )


def _derived(fact: DataFrame) -> DataFrame:
    return facts.derived_measures(fact).select(
        "trip_id", "tip_percentage", "avg_speed_mph", "revenue_per_mile"
    )


FACTS: dict[str, Query] = {
    "fact_trips": _on_trips(facts.fact_trips),
    "fact_trips_incremental": _on_fact(_incremental),
    "trip_duration": _on_fact(_durations),
    "trip_derived_measures": _on_fact(_derived),
    "fact_trips_daily_agg": _on_fact(facts.daily_agg),
    "fact_trips_hourly_agg": _on_fact(facts.hourly_agg),
    "heatmap_from_hourly": _on_fact(lambda f: facts.heatmap_from_hourly(facts.hourly_agg(f))),
    "daily_to_monthly": _on_fact(lambda f: facts.daily_to_monthly(facts.daily_agg(f))),
    "fact_trip_summary": _on_trips(summaries.trip_summary),
    "trip_summary_by_event_month": _on_trips(summaries.trip_summary_by_event_month),
    "fact_fare_summary": _on_trips(summaries.fare_summary),
    "fare_summary_preview": _on_trips(summaries.fare_summary_preview),
    "fact_trip_locations": _on_trips(
        lambda t: summaries.trip_locations(summaries.known_places(t))
    ),
    "trip_locations_top10": _on_trips(summaries.trip_locations_top),
}


def _members(name: str, **roles: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        dim = dimensions.short_dimension(spark, name)
        return dimensions.member_usage(dim, stored.fact(spark, sf_dir), roles)

    return run


def _dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("pickup_datetime").cast("date")
    bounds = stored.trips(spark, sf_dir).agg(F.min(day).alias("first"), F.max(day).alias("last"))
    calendar = dimensions.calendar_between(bounds)
    return dimensions.member_usage(calendar, stored.fact(spark, sf_dir), {"trips": "pickup_date_key"})


def _dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.member_usage(
        dimensions.clock(spark), stored.fact(spark, sf_dir), {"trips": "pickup_time_key"}
    )


DIMENSIONS: dict[str, Query] = {
    "dim_location": _members(
        "dim_location", pickups="pickup_location_id", dropoffs="dropoff_location_id"
    ),
    "dim_vendor": _members("dim_vendor", trips="vendor_id"),
    "dim_payment_type": _members("dim_payment_type", trips="payment_type_id"),
    "dim_rate_code": _members("dim_rate_code", trips="ratecode_id"),
    "dim_trip_type": _members("dim_trip_type", trips="trip_type_id"),
    "dim_file_source": _members("dim_file_source", trips="file_type"),
    "dim_store_fwd_flag": _members("dim_store_fwd_flag", trips="store_fwd_flag"),
    "dim_date": _dim_date,
    "dim_time": _dim_time,
    "dim_date_pg": _on_trips(
        lambda t: dimensions.calendar_since_first_month(summaries.trip_summary(t), AS_OF)
    ),
    "dim_location_pg": _on_trips(
        lambda t: dimensions.discovered_locations(
            summaries.trip_locations(summaries.known_places(t))
        )
    ),
}

MARTS: dict[str, Query] = {name: _mart(name) for name in marts.MARTS}


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = _mart("monthly_trends")(spark, sf_dir)
    path = scratch_dir(spark, "export")
    exports.export_csv(result, path)
    return exports.import_csv(spark, path, result.schema)


INSIGHTS: dict[str, Query] = {
    "heatmap_overall_pivot": _over("hourly_demand_heatmap", heatmap.overall_pivot),
    "heatmap_service_pivot": _over("hourly_demand_heatmap", heatmap.service_pivot),
    "hourly_pattern": _over("hourly_demand_heatmap", heatmap.hourly_pattern),
    "daily_pattern": _over("hourly_demand_heatmap", heatmap.daily_pattern),
    "peak_insights": _over("hourly_demand_heatmap", heatmap.peak_insights),
    "heatmap_coverage": _over("hourly_demand_heatmap", heatmap.coverage),
    "top_hours_per_service": _over("hourly_demand_heatmap", heatmap.top_hours_per_service),
    "rush_totals": _over("hourly_demand_heatmap", heatmap.rush_totals),
    "weekday_weekend": _over("hourly_demand_heatmap", heatmap.weekday_weekend),
    "high_value_slots": _over("hourly_demand_heatmap", heatmap.high_value_slots),
    "period_analysis": _over("hourly_demand_heatmap", heatmap.period_analysis),
    "top_n_by_metric": _over(
        "top_routes", lambda m: routes.top_n_by_metric(m, routes.METRICS)
    ),
    "borough_flow": _over("top_routes", routes.borough_flow),
    "route_service_stats": _over("top_routes", routes.service_stats),
    "route_insights": _over("top_routes", routes.insights),
    "route_totals": _over("top_routes", routes.totals),
    "borough_performance": _over("top_routes", routes.borough_performance),
    "route_efficiency": _over("top_routes", routes.efficiency),
    "airport_headline": _over("airport_traffic", airports.headline),
    "airport_direction": _over("airport_traffic", airports.by_direction),
    "airport_performance": _over("airport_traffic", airports.performance),
    "airport_time_patterns": _over("airport_traffic", airports.time_patterns),
    "airport_service_share": _over("airport_traffic", airports.service_share),
    "airport_recent_months": _over("airport_traffic", airports.recent_months),
    "trend_summary": _over("monthly_trends", trends.summary),
    "trend_series": _over("monthly_trends", trends.series),
    "trend_extremes": _over("monthly_trends", trends.extremes),
    "trend_service_performance": _over("monthly_trends", trends.service_performance),
    "executive_ratios": _over("executive_kpis", headlines.executive_ratios),
    "executive_insights": _over("executive_kpis", headlines.executive_insights),
    "service_share": _over("service_comparison", headlines.service_share),
    "service_bands": _over("service_comparison", headlines.service_bands),
    "export_csv_roundtrip": _csv_roundtrip,
}

ANALYTICS: dict[str, Query] = {**FACTS, **DIMENSIONS, **MARTS, **INSIGHTS}
