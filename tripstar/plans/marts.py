"""The thirteen analytic marts, each a function of the star."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstar.functions import exact, temporal
from tripstar.operators.facts import derived_measures
from tripstar.operators.partials import average, merge, reduce_trips, total
from tripstar.star import Star

_DAY = "pickup_date_key"
_HOUR = "pickup_time_key"


def trip_analytics(star: Star) -> DataFrame:
    """Every trip with all its attributes; unmatched keys leave NULLs.

    Drop-off date and time give no column, so they are not joined. All dimensions
    are small: the plan is one pass over the trips without a shuffle.
    """
    rows = derived_measures(star.fact_trips)
    same = lambda *names: {n: n for n in names}

    def attach(dim: str, on: str, attributes: dict[str, str]) -> None:
        nonlocal rows
        rows = star.attach(rows, dim, on, attributes, "left")

    attach("dim_file_source", "file_type", same("service_name", "service_category"))
    attach("dim_date", _DAY, {
        "pickup_date": "full_date", "pickup_year": "year", "pickup_month": "month",
        "pickup_month_name": "month_name", "pickup_quarter": "quarter",
        "pickup_day_of_week": "day_of_week", "pickup_day_name": "day_name",
        "pickup_is_weekend": "is_weekend", "pickup_week": "week_of_year",
    })
    attach("dim_time", _HOUR, {
        "pickup_hour": "hour", "pickup_time": "hour_minute",
        "pickup_time_period": "time_period", "pickup_is_rush_hour": "rush_hour_flag",
        "pickup_is_business_hours": "business_hours_flag",
    })
    for end in ("pickup", "dropoff"):
        attach("dim_location", f"{end}_location_id", {
            f"_{end}_location_id": "location_id", f"{end}_zone": "zone_name",
            f"{end}_borough": "borough", f"{end}_is_airport": "is_airport",
            f"{end}_is_manhattan": "is_manhattan",
        })
    attach("dim_vendor", "vendor_id", same("vendor_name", "vendor_category"))
    attach("dim_payment_type", "payment_type_id",
           same("payment_method", "payment_category", "is_cashless"))
    attach("dim_rate_code", "ratecode_id",
           same("rate_description", "rate_category", "is_airport_rate"))
    attach("dim_trip_type", "trip_type_id", same("trip_description"))
    attach("dim_store_fwd_flag", "store_fwd_flag",
           {"store_forward_status": "flag_description"})

    return rows.select(
        "trip_id", "file_type", "service_name", "service_category",
        "pickup_date", "pickup_year", "pickup_month", "pickup_month_name", "pickup_quarter",
        "pickup_day_of_week", "pickup_day_name", "pickup_is_weekend", "pickup_week",
        "pickup_hour", "pickup_time", "pickup_time_period", "pickup_is_rush_hour",
        "pickup_is_business_hours",
        F.col("_pickup_location_id").alias("pickup_location_id"),
        "pickup_zone", "pickup_borough", "pickup_is_airport", "pickup_is_manhattan",
        F.col("_dropoff_location_id").alias("dropoff_location_id"),
        "dropoff_zone", "dropoff_borough", "dropoff_is_airport", "dropoff_is_manhattan",
        "vendor_name", "vendor_category", "payment_method", "payment_category", "is_cashless",
        "rate_description", "rate_category", "is_airport_rate", "trip_description",
        "store_forward_status",
        "passenger_count", "trip_distance", "trip_duration_minutes",
        "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
        "improvement_surcharge", "congestion_surcharge", "airport_fee", "total_amount",
        "tip_percentage", "avg_speed_mph", "revenue_per_mile",
        "dispatching_base_num", "affiliated_base_number", "sr_flag",
    )


def revenue_analytics(star: Star) -> DataFrame:
    """Revenue per day, service, vendor and payment method."""
    measures = [
        "revenue", "fare", "tip", "tolls", "congestion", "passengers", "distance", "duration",
        "tip_percent",
    ]
    rows = reduce_trips(
        star.fact_trips, [_DAY, "file_type", "vendor_id", "payment_type_id"], measures
    )
    days = ["full_date", "year", "month", "month_name", "quarter", "is_weekend"]
    rows = star.attach(rows, "dim_date", _DAY, {c: c for c in days})
    rows = _service(star, rows)
    rows = star.attach(rows, "dim_vendor", "vendor_id", {"vendor_name": "vendor_name"}, "left")
    rows = star.attach(
        rows, "dim_payment_type", "payment_type_id", {"payment_method": "payment_method"}, "left"
    )
    by = [*days, "service_name", "vendor_name", "payment_method"]
    return merge(rows, by, measures).select(
        *by,
        F.col("trips").alias("trip_count"),
        total("revenue").alias("total_revenue"),
        total("fare").alias("total_fares"),
        total("tip").alias("total_tips"),
        total("tolls").alias("total_tolls"),
        total("congestion").alias("total_congestion_charges"),
        average("revenue").alias("avg_trip_revenue"),
        average("fare").alias("avg_fare"),
        average("tip_percent").alias("avg_tip_percentage"),
        total("passengers").alias("total_passengers"),
        average("distance").alias("avg_trip_distance"),
        average("duration").alias("avg_trip_duration"),
    )


def location_performance(star: Star) -> DataFrame:
    """Route performance; active days are counted from rows already cut to one per day."""
    measures = ["distance", "duration", "revenue", "speed"]
    ends = ["pickup_location_id", "dropoff_location_id"]
    rows = _routes(star, reduce_trips(star.fact_trips, [*ends, "file_type", _DAY], measures))
    by = [*_ROUTE, "service_name"]
    return merge(rows, by, measures, days=F.countDistinct(_DAY)).select(
        *by,
        F.col("trips").alias("trip_count"),
        average("distance").alias("avg_distance"),
        average("duration").alias("avg_duration"),
        average("revenue").alias("avg_revenue"),
        total("revenue").alias("total_revenue"),
        average("speed").alias("avg_speed_mph"),
        F.col("days").alias("active_days"),
    )


def time_patterns(star: Star) -> DataFrame:
    """Demand and averages per hour, part of day, day of week and service."""
    measures = ["revenue", "distance", "duration", "passengers", "speed"]
    slot = ["pickup_hour", "time_period", "rush_hour_flag", "day_name", "is_weekend"]
    rows = star.attach(star.fact_trips, "dim_time", _HOUR, {
        "pickup_hour": "hour", "time_period": "time_period", "rush_hour_flag": "rush_hour_flag",
    })
    rows = star.attach(
        rows, "dim_date", _DAY, {"day_name": "day_name", "is_weekend": "is_weekend"}
    )
    rows = _service(star, reduce_trips(rows, [*slot, "file_type"], measures))
    by = [*slot, "service_name"]
    return merge(rows, by, measures).select(
        *by,
        F.col("trips").alias("trip_count"),
        average("revenue").alias("avg_revenue"),
        average("distance").alias("avg_distance"),
        average("duration").alias("avg_duration"),
        average("passengers").alias("avg_passengers"),
        total("revenue").alias("total_revenue"),
        average("speed").alias("avg_speed_mph"),
    )


def payment_behavior(star: Star) -> DataFrame:
    """Payment methods per service and month, with how often and how much is tipped."""
    measures = ["revenue", "tip", "tip_percent"]
    rows = reduce_trips(
        star.fact_trips, ["payment_type_id", "file_type", _DAY], measures,
        tipped=F.col("tip_amount") > 0,
    )
    method = ["payment_method", "payment_category", "is_cashless"]
    rows = star.attach(rows, "dim_payment_type", "payment_type_id", {c: c for c in method})
    rows = _months(star, _service(star, rows), "year", "month_name")
    by = [*method, "service_name", "year", "month_name"]
    return merge(rows, by, measures, "tipped").select(
        *by,
        F.col("trips").alias("trip_count"),
        average("revenue").alias("avg_total_amount"),
        average("tip").alias("avg_tip_amount"),
        average("tip_percent").alias("avg_tip_percentage"),
        total("revenue").alias("total_revenue"),
        total("tip").alias("total_tips"),
        F.col("tipped").alias("trips_with_tips"),
        exact.percent(F.col("tipped"), F.col("trips")).alias("tip_frequency_percentage"),
    )


def executive_kpis(star: Star, as_of: date) -> DataFrame:
    """Headline figures of the month of ``as_of`` and growth over the month before.

    One pass over the two months; the date range reaches the scan as a filter.
    """
    this = temporal.month_range(as_of.year, as_of.month)
    last = temporal.month_range(*temporal.previous_month(as_of.year, as_of.month))
    fact = star.fact_trips.filter(
        F.col(_DAY).between(*this) | F.col(_DAY).between(*last)
    )
    measures = ["revenue", "passengers", "distance", "duration"]
    days = star.attach(reduce_trips(fact, [_DAY], measures), "dim_date", _DAY, {"_year": "year"})
    now = F.col(_DAY).between(*this)

    def part(column: str, current: bool) -> Column:
        return F.sum(F.when(now if current else ~now, F.col(column)))

    def mean(measure: str) -> Column:
        return exact.mean(part(f"sum_{measure}", True), part(f"n_{measure}", True))

    trips = F.coalesce(part("trips", True), F.lit(0))
    trips_before = F.coalesce(part("trips", False), F.lit(0))
    return days.agg(
        F.lit("Current Month").alias("period"),
        trips.alias("total_trips"),
        part("sum_revenue", True).cast("decimal(20,2)").alias("total_revenue"),
        mean("revenue").alias("avg_trip_value"),
        part("sum_passengers", True).alias("total_passengers"),
        mean("distance").alias("avg_distance"),
        mean("duration").alias("avg_duration"),
        exact.growth(trips, trips_before).alias("trips_growth_pct"),
        exact.growth(part("sum_revenue", True), part("sum_revenue", False)).alias(
            "revenue_growth_pct"
        ),
    )


def service_comparison(star: Star) -> DataFrame:
    """Services side by side.

    Both distinct counts are taken over rows already reduced to one per payment
    type, day and vendor, so the expansion they cause stays small.
    """
    measures = ["revenue", "distance", "duration", "passengers", "tip_percent"]
    rows = reduce_trips(
        star.fact_trips, ["file_type", "payment_type_id", _DAY, "vendor_id"], measures
    )
    rows = star.attach(
        rows, "dim_payment_type", "payment_type_id", {"is_cashless": "is_cashless"}, "left"
    )
    rows = _service(star, rows, "service_name", "service_category").withColumn(
        "cashless", F.when(F.col("is_cashless"), F.col("trips")).otherwise(0)
    )
    by = ["service_name", "service_category"]
    merged = merge(
        rows, by, measures, "cashless",
        days=F.countDistinct(_DAY), vendors=F.countDistinct("vendor_id"),
    )
    return merged.select(
        *by,
        F.col("trips").alias("total_trips"),
        total("revenue").alias("total_revenue"),
        average("revenue").alias("avg_revenue_per_trip"),
        average("distance").alias("avg_trip_distance"),
        average("duration").alias("avg_trip_duration"),
        average("passengers").alias("avg_passengers"),
        average("tip_percent").alias("avg_tip_percentage"),
        F.col("cashless").alias("cashless_trips"),
        exact.percent(F.col("cashless"), F.col("trips")).alias("cashless_percentage"),
        F.col("days").alias("operating_days"),
        F.col("vendors").alias("active_vendors"),
    )


def hourly_demand_heatmap(star: Star) -> DataFrame:
    """Trips per weekday, hour and service, scaled to the service's busiest slot."""
    rows = star.attach(
        star.fact_trips, "dim_date", _DAY, {"day_name": "day_name", "day_of_week": "day_of_week"}
    )
    rows = star.attach(rows, "dim_time", _HOUR, {"hour": "hour"})
    slot = ["day_name", "day_of_week", "hour"]
    rows = _service(star, reduce_trips(rows, [*slot, "file_type"], ["revenue"]))
    merged = merge(rows, [*slot, "service_name"], ["revenue"])
    busiest = F.max("trips").over(Window.partitionBy("service_name"))
    return merged.select(
        *slot,
        "service_name",
        F.col("trips").alias("trip_count"),
        average("revenue").alias("avg_revenue"),
        exact.percent(F.col("trips"), busiest).alias("demand_intensity"),
    )


def top_routes(star: Star, min_trips: int = 100, limit: int = 100) -> DataFrame:
    """The busiest routes with their rank by trips and by revenue within the service.

    Ranks are taken after the minimum is applied and before the limit; ties in the
    final order follow the route's names.
    """
    measures = ["revenue", "distance", "duration"]
    ends = ["pickup_location_id", "dropoff_location_id"]
    known = star.fact_trips.filter((F.col(ends[0]) != 0) & (F.col(ends[1]) != 0))
    rows = _routes(star, reduce_trips(known, [*ends, "file_type"], measures))
    by = [*_ROUTE, "service_name"]
    service = Window.partitionBy("service_name")
    return (
        merge(rows, by, measures)
        .filter(F.col("trips") > min_trips)
        .select(
            *by,
            F.col("trips").alias("trip_count"),
            total("revenue").alias("total_revenue"),
            average("revenue").alias("avg_revenue"),
            average("distance").alias("avg_distance"),
            average("duration").alias("avg_duration"),
            F.rank().over(service.orderBy(F.desc("trips"))).alias("route_rank_by_volume"),
            F.rank().over(service.orderBy(F.desc_nulls_first("sum_revenue"))).alias(
                "route_rank_by_revenue"
            ),
        )
        .orderBy(F.desc("trip_count"), *by)
        .limit(limit)
    )


def monthly_trends(star: Star) -> DataFrame:
    """Monthly figures per service with the change from the month before it in the data."""
    measures = ["revenue", "passengers", "distance"]
    rows = reduce_trips(star.fact_trips, ["file_type", _DAY], measures)
    rows = _months(star, _service(star, rows), "year", "month", "month_name")
    by = ["year", "month", "month_name", "service_name"]
    merged = merge(rows, by, measures)
    order = Window.partitionBy("service_name").orderBy("year", "month")
    trips, revenue = F.col("trips"), total("revenue")
    trips_before = F.lag("trips").over(order)
    revenue_before = F.lag(revenue).over(order)
    return merged.select(
        *by,
        trips.alias("trip_count"),
        revenue.alias("total_revenue"),
        average("revenue").alias("avg_revenue_per_trip"),
        total("passengers").alias("total_passengers"),
        average("distance").alias("avg_distance"),
        trips_before.alias("prev_month_trips"),
        revenue_before.alias("prev_month_revenue"),
        exact.growth(trips, trips_before).alias("trips_mom_growth"),
        exact.growth(revenue, revenue_before).alias("revenue_mom_growth"),
    ).orderBy("year", "month", "service_name")


def airport_traffic(star: Star) -> DataFrame:
    """Trips from and to airports; a trip between two airports counts as from.

    Both ends are looked up per trip because that drops most trips at once.
    """
    measures = ["revenue", "distance", "duration"]
    rows = star.fact_trips
    for end in ("pickup", "dropoff"):
        rows = star.attach(rows, "dim_location", f"{end}_location_id", {
            f"{end}_airport": F.when(F.col("is_airport"), F.col("zone_name")),
            f"{end}_is_airport": "is_airport",
        })
    rows = rows.filter(F.col("pickup_is_airport") | F.col("dropoff_is_airport")).withColumns({
        "trip_type": F.when(F.col("pickup_is_airport"), "From Airport").otherwise("To Airport"),
        "airport_name": F.when(F.col("pickup_is_airport"), F.col("pickup_airport")).otherwise(
            F.col("dropoff_airport")
        ),
    })
    rows = star.attach(rows, "dim_time", _HOUR, {"time_period": "time_period"})
    rows = reduce_trips(
        rows, ["trip_type", "airport_name", "file_type", _DAY, "time_period"], measures
    )
    rows = _months(star, _service(star, rows), "year", "month_name")
    by = ["trip_type", "airport_name", "service_name", "year", "month_name", "time_period"]
    return merge(rows, by, measures).select(
        *by,
        F.col("trips").alias("trip_count"),
        average("revenue").alias("avg_fare"),
        average("distance").alias("avg_distance"),
        average("duration").alias("avg_duration"),
        total("revenue").alias("total_revenue"),
    )


def vendor_performance(star: Star) -> DataFrame:
    """Vendors per service and month with their share of the month's trips."""
    measures = ["revenue", "distance", "duration", "tip_percent"]
    known = star.fact_trips.filter(F.col("vendor_id") != 0)
    rows = reduce_trips(known, ["vendor_id", "file_type", _DAY, "pickup_location_id"], measures)
    vendor = ["vendor_name", "vendor_category"]
    rows = star.attach(rows, "dim_vendor", "vendor_id", {c: c for c in vendor})
    rows = _months(star, _service(star, rows), "year", "month_name")
    by = [*vendor, "service_name", "year", "month_name"]
    merged = merge(
        rows, by, measures,
        days=F.countDistinct(_DAY), places=F.countDistinct("pickup_location_id"),
    )
    month = Window.partitionBy("service_name", "year", "month_name")
    return merged.select(
        *by,
        F.col("trips").alias("trip_count"),
        total("revenue").alias("total_revenue"),
        average("revenue").alias("avg_revenue_per_trip"),
        average("distance").alias("avg_trip_distance"),
        average("duration").alias("avg_trip_duration"),
        average("tip_percent").alias("avg_tip_percentage"),
        F.col("days").alias("operating_days"),
        F.col("places").alias("coverage_locations"),
        exact.percent(F.col("trips"), F.sum("trips").over(month)).alias("market_share_pct"),
    )


def rush_hour_analysis(star: Star) -> DataFrame:
    """Rush hours against other hours, on weekdays and weekends."""
    measures = ["revenue", "distance", "duration", "speed", "passengers"]
    rows = star.attach(
        star.fact_trips, "dim_time", _HOUR, {"rush_hour_flag": "rush_hour_flag"}
    )
    rows = star.attach(rows, "dim_date", _DAY, {"is_weekend": "is_weekend"})
    slot = ["rush_hour_flag", "is_weekend"]
    rows = _service(star, reduce_trips(rows, [*slot, "file_type"], measures))
    label = F.when(F.col("rush_hour_flag"), "Rush Hour").otherwise("Non-Rush Hour")
    return merge(rows, [*slot, "service_name"], measures).select(
        "rush_hour_flag",
        label.alias("period_type"),
        "is_weekend",
        "service_name",
        F.col("trips").alias("trip_count"),
        average("revenue").alias("avg_fare"),
        average("distance").alias("avg_distance"),
        average("duration").alias("avg_duration"),
        average("speed").alias("avg_speed_mph"),
        average("passengers").alias("avg_passengers"),
        total("revenue").alias("total_revenue"),
    )


# ---------------------------------------------------------------------------
# Shared joins
# ---------------------------------------------------------------------------
_ROUTE = ["pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone"]


def _service(star: Star, rows: DataFrame, *columns: str) -> DataFrame:
    return star.attach(
        rows, "dim_file_source", "file_type", {c: c for c in columns or ("service_name",)}
    )


def _months(star: Star, rows: DataFrame, *columns: str) -> DataFrame:
    return star.attach(rows, "dim_date", _DAY, {c: c for c in columns})


def _routes(star: Star, rows: DataFrame) -> DataFrame:
    for end in ("pickup", "dropoff"):
        rows = star.attach(
            rows, "dim_location", f"{end}_location_id",
            {f"{end}_borough": "borough", f"{end}_zone": "zone_name"},
        )
    return _service(star, rows)


MARTS = {
    "trip_analytics": trip_analytics,
    "revenue_analytics": revenue_analytics,
    "location_performance": location_performance,
    "time_patterns": time_patterns,
    "payment_behavior": payment_behavior,
    "executive_kpis": executive_kpis,
    "service_comparison": service_comparison,
    "hourly_demand_heatmap": hourly_demand_heatmap,
    "top_routes": top_routes,
    "monthly_trends": monthly_trends,
    "airport_traffic": airport_traffic,
    "vendor_performance": vendor_performance,
    "rush_hour_analysis": rush_hour_analysis,
}


def create_views(star: Star, as_of: date, prefix: str = "vw_") -> list[str]:
    """Register every mart as a temporary view for use from SQL."""
    names = []
    for name, mart in MARTS.items():
        view = mart(star, as_of) if name == "executive_kpis" else mart(star)
        view.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
