"""Second-level analysis of the hourly demand mart.

Averages over mart rows are unweighted: every slot counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstar.functions import exact, labels

WEEK = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
HOURS = list(range(24))


def with_full_day_names(heatmap: DataFrame) -> DataFrame:
    return heatmap.withColumn("day_name", labels.full_day_name(F.col("day_name")))


def slot_mean(column: str) -> Column:
    """Unweighted mean over mart rows."""
    return exact.stable(F.avg(column))


def overall_pivot(heatmap: DataFrame) -> DataFrame:
    """Mean intensity per weekday (rows) and hour (columns ``h00``..``h23``)."""
    return _by_hour(with_full_day_names(heatmap), ["day_name"])


def service_pivot(heatmap: DataFrame, service: str | None = None) -> DataFrame:
    """The same per service, or for one service only."""
    rows = with_full_day_names(heatmap)
    if service is not None:
        rows = rows.filter(F.col("service_name") == service)
    return _by_hour(rows, ["service_name", "day_name"])


def _by_hour(rows: DataFrame, by: list[str]) -> DataFrame:
    # every weekday gets a row, also one without trips
    day = F.col("_day")
    spread = rows.withColumn("_day", F.explode(F.array(*map(F.lit, WEEK)))).withColumn(
        "_intensity", F.when(day == F.col("day_name"), F.col("demand_intensity"))
    )
    groups = by[:-1]
    pivoted = spread.groupBy(*groups, "_day").pivot("hour", HOURS).agg(slot_mean("_intensity"))
    hours = [F.coalesce(F.col(str(h)), F.lit(0.0)).alias(f"h{h:02d}") for h in HOURS]
    position = F.array_position(F.array(*map(F.lit, WEEK)), F.col("day_name"))
    return pivoted.select(*groups, day.alias("day_name"), *hours).orderBy(*groups, position)


def hourly_pattern(heatmap: DataFrame) -> DataFrame:
    """Trips and mean revenue per hour and service."""
    return heatmap.groupBy("hour", "service_name").agg(
        F.sum("trip_count").alias("trip_count"), slot_mean("avg_revenue").alias("avg_revenue")
    )


def daily_pattern(heatmap: DataFrame) -> DataFrame:
    """Trips and mean revenue per weekday and service, in order of the week."""
    return (
        with_full_day_names(heatmap)
        .groupBy("day_name", "day_of_week", "service_name")
        .agg(
            F.sum("trip_count").alias("trip_count"),
            slot_mean("avg_revenue").alias("avg_revenue"),
        )
        .orderBy("day_of_week", "service_name")
    )


def peak_insights(heatmap: DataFrame) -> DataFrame:
    """Busiest hour, busiest day, and busiest hour per service; ties go to the first."""
    hour = F.lpad(F.col("hour").cast("string"), 2, "0")
    entry = lambda kind, scope, label, order: F.struct(
        F.lit(kind).alias("insight"), scope.alias("scope"), label.alias("label"),
        order.alias("position"),
    )
    entries = F.array(
        entry("peak_hour", F.lit("all"), hour, F.col("hour")),
        entry("peak_day", F.lit("all"), F.col("day_name"), F.col("day_of_week")),
        entry("service_peak_hour", F.col("service_name"), hour, F.col("hour")),
    )
    totals = (
        with_full_day_names(heatmap)
        .select(F.explode(entries).alias("e"), "trip_count")
        .groupBy("e")
        .agg(F.sum("trip_count").alias("trips"))
    )
    first = F.min_by(
        F.struct(F.col("e.label").alias("label"), F.col("trips")),
        F.struct(-F.col("trips"), F.col("e.position")),
    )
    return (
        totals.groupBy(F.col("e.insight").alias("insight"), F.col("e.scope").alias("scope"))
        .agg(first.alias("best"))
        .select("insight", "scope", F.col("best.label").alias("label"),
                F.col("best.trips").alias("trips"))
    )


def coverage(heatmap: DataFrame) -> DataFrame:
    """How many hours and days have data, and the mean intensity."""
    return heatmap.agg(
        F.countDistinct("hour").alias("hours_covered"),
        F.countDistinct("day_name").alias("days_covered"),
        slot_mean("demand_intensity").alias("avg_intensity"),
    )


def top_hours_per_service(heatmap: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` most intense hours of each service, next to the service's totals."""
    service = Window.partitionBy("service_name")
    hours = heatmap.groupBy("service_name", "hour").agg(
        slot_mean("demand_intensity").alias("intensity"),
        F.sum("trip_count").alias("trips"),
        F.sum("avg_revenue").alias("revenue"),
        F.count("avg_revenue").alias("slots"),
        F.max("demand_intensity").alias("top"),
    )
    ranked = hours.withColumns({
        "position": F.row_number().over(service.orderBy(F.desc("intensity"), "hour")),
        "total_trips": F.sum("trips").over(service),
        "avg_revenue": exact.stable(
            exact.mean(F.sum("revenue").over(service), F.sum("slots").over(service))
        ),
        "max_intensity": F.max("top").over(service),
    })
    return ranked.filter(F.col("position") <= n).select(
        "service_name", "position", "hour", "intensity",
        labels.demand_band(F.col("intensity")).alias("band"),
        "total_trips", "avg_revenue", "max_intensity",
    )


def rush_totals(heatmap: DataFrame) -> DataFrame:
    """Trips in the morning (6 to 10) and evening (17 to 21) hours."""
    in_hours = lambda a, b: F.coalesce(
        F.sum(F.when(F.col("hour").between(a, b), F.col("trip_count"))), F.lit(0)
    )
    return heatmap.agg(
        in_hours(6, 10).alias("morning_trips"), in_hours(17, 21).alias("evening_trips")
    )


def weekday_weekend(heatmap: DataFrame) -> DataFrame:
    """Trips on weekdays and weekends, and the busiest day."""
    days = with_full_day_names(heatmap).groupBy("day_of_week", "day_name").agg(
        F.sum("trip_count").alias("trips")
    )
    weekend = F.col("day_of_week").isin(1, 7)
    busiest = F.max_by(F.struct("day_name", "trips"), F.struct("trips", -F.col("day_of_week")))
    return days.agg(
        F.coalesce(F.sum(F.when(~weekend, F.col("trips"))), F.lit(0)).alias("weekday_trips"),
        F.coalesce(F.sum(F.when(weekend, F.col("trips"))), F.lit(0)).alias("weekend_trips"),
        busiest.alias("busiest"),
    ).select(
        "weekday_trips", "weekend_trips", F.col("busiest.day_name").alias("peak_day"),
        F.col("busiest.trips").alias("peak_day_trips"),
    )


def high_value_slots(heatmap: DataFrame, intensity: float = 70) -> DataFrame:
    """Mean revenue of slots above the upper quartile, and of busy slots.

    The exact quartile is taken over slots: at most 168 per service.
    """
    revenue, quartile = F.col("avg_revenue"), F.col("quartile")
    slots = heatmap.withColumn(
        "quartile", F.percentile("avg_revenue", F.lit(0.75)).over(Window.partitionBy())
    )
    return slots.agg(
        exact.stable(F.max(quartile)).alias("revenue_quartile"),
        exact.stable(F.avg(F.when(revenue > quartile, revenue))).alias("high_revenue_mean"),
        exact.stable(F.avg(F.when(F.col("demand_intensity") > intensity, revenue))).alias(
            "high_demand_mean"
        ),
    )


def period_analysis(heatmap: DataFrame) -> DataFrame:
    """Totals, means and demand band per coarse part of the day."""
    return (
        heatmap.groupBy(labels.day_period(F.col("hour")).alias("time_period"))
        .agg(
            F.sum("trip_count").alias("trip_count"),
            slot_mean("avg_revenue").alias("avg_revenue"),
            slot_mean("demand_intensity").alias("demand_intensity"),
        )
        .withColumn("band", labels.demand_band(F.col("demand_intensity")))
    )
