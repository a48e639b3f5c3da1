"""Second-level analysis of the executive and service comparison marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstar.functions import exact, labels


def _guarded(numerator: Column, denominator: Column) -> Column:
    """Ratio, 0 where the base is not positive."""
    positive = F.when(denominator > 0, denominator)
    return F.when(
        denominator > 0, exact.stable(numerator.cast("double") / positive.cast("double"))
    ).otherwise(0.0)


def executive_ratios(kpis: DataFrame, days: int = 90) -> DataFrame:
    """Ratios of the headline figures, and the figures the growth rates imply."""
    c = F.col
    implied = lambda now, pct: exact.stable(
        c(now).cast("double") / F.nullif(1 + c(pct) / 100, F.lit(0.0))
    )
    return kpis.select(
        _guarded(c("total_passengers"), c("total_trips")).alias("passengers_per_trip"),
        _guarded(c("avg_distance") * 60, c("avg_duration")).alias("avg_speed"),
        _guarded(c("total_revenue"), c("total_passengers")).alias("revenue_per_passenger"),
        _guarded(c("total_revenue"), c("total_trips") * c("avg_distance")).alias(
            "revenue_per_mile"
        ),
        exact.stable(c("total_trips") / F.lit(days)).alias("trips_per_day"),
        implied("total_trips", "trips_growth_pct").alias("previous_trips"),
        implied("total_revenue", "revenue_growth_pct").alias("previous_revenue"),
    )


def executive_insights(kpis: DataFrame) -> DataFrame:
    """Short codes of what the headline figures say, joined by commas."""
    c = F.col
    trips, revenue = c("trips_growth_pct"), c("revenue_growth_pct")
    known = trips.isNotNull() & revenue.isNotNull()
    passengers = _guarded(c("total_passengers"), c("total_trips"))
    speed = _guarded(c("avg_distance") * 60, c("avg_duration"))
    growth = (
        F.when(known & (trips > 0) & (revenue > 0), "strong_growth")
        .when(known & (trips > 0) & (revenue < 0), "volume_up_revenue_down")
        .when(known & (trips < 0) & (revenue > 0), "volume_down_revenue_up")
        .when(known, "declining")
    )
    value = F.when(c("avg_trip_value") > 25, "premium_value").when(
        c("avg_trip_value") < 15, "low_value"
    )
    density = F.when(passengers > 1.5, "good_density")
    pace = F.when(speed > 15, "good_speed").when(speed < 10, "low_speed")
    codes = F.array_compact(F.array(growth, value, density, pace))
    return kpis.select("period", F.array_join(codes, ",").alias("insights"))


def service_share(comparison: DataFrame) -> DataFrame:
    """Services with their share of all revenue and trips, highest revenue first."""
    everything = Window.partitionBy()  # one row per service
    share = lambda c: exact.percent(
        F.col(c), F.sum(c).over(everything)
    )
    return comparison.select(
        "service_name", "service_category", "total_trips", "total_revenue",
        share("total_revenue").alias("revenue_share_pct"),
        share("total_trips").alias("trip_share_pct"),
        exact.stable(F.avg("avg_tip_percentage").over(everything)).alias("mean_tip_percentage"),
    ).orderBy(F.desc_nulls_last("total_revenue"), "service_name")


def service_bands(comparison: DataFrame) -> DataFrame:
    return comparison.select(
        "service_name", "service_category", "cashless_percentage",
        labels.cashless_band(F.col("cashless_percentage")).alias("cashless_band"),
        labels.service_class(F.col("service_category")).alias("service_class"),
    )
