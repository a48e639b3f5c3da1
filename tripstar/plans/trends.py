"""Second-level analysis of the monthly trends mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstar.functions import exact, labels


def summary(trends: DataFrame) -> DataFrame:
    """Number of points, services and years, and mean growth over months that have one."""
    return trends.agg(
        F.count(F.lit(1)).alias("data_points"),
        F.countDistinct("service_name").alias("services"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        exact.stable(F.avg("trips_mom_growth")).alias("avg_trip_growth"),
        exact.stable(F.avg("revenue_mom_growth")).alias("avg_revenue_growth"),
    )


def series(trends: DataFrame, service: str | None = None) -> DataFrame:
    """Labelled monthly series in order, of one service or of each."""
    rows = trends if service is None else trends.filter(F.col("service_name") == service)
    return rows.select(
        "service_name", "year", "month",
        labels.short_month_label(F.col("month_name"), F.col("year")).alias("month_label"),
        "trip_count", "total_revenue", "avg_revenue_per_trip",
        labels.growth_sign(F.col("trips_mom_growth")).alias("trip_growth_sign"),
        labels.growth_sign(F.col("revenue_mom_growth")).alias("revenue_growth_sign"),
    ).orderBy("service_name", "year", "month")


def extremes(trends: DataFrame) -> DataFrame:
    """Best and worst month by each growth figure, over rows that have both.

    On a tie the earliest month counts, then the first service.
    """
    rows = trends.dropna(subset=["trips_mom_growth", "revenue_mom_growth"])
    ties = [F.col("year"), F.col("month"), F.col("service_name")]

    def pick(kind: str, metric: str, best: bool) -> Column:
        found = F.struct(
            F.lit(kind).alias("insight"), "service_name", "year", "month_name",
            F.col(metric).alias("growth"),
        )
        first = -F.col(metric) if best else F.col(metric)
        return F.min_by(found, F.struct(first, *ties))

    found = F.array(
        pick("best_trip_growth", "trips_mom_growth", True),
        pick("best_revenue_growth", "revenue_mom_growth", True),
        pick("worst_trip_growth", "trips_mom_growth", False),
        pick("worst_revenue_growth", "revenue_mom_growth", False),
    )
    return rows.agg(found.alias("found")).select(F.inline(F.array_compact("found")))


def service_performance(trends: DataFrame) -> DataFrame:
    """Unweighted monthly means per service, highest revenue first."""
    mean = lambda c: F.round(F.avg(F.col(c).cast("double")), 2).alias(c)
    return (
        trends.groupBy("service_name")
        .agg(
            mean("trip_count"), mean("total_revenue"), mean("avg_revenue_per_trip"),
            mean("trips_mom_growth"), mean("revenue_mom_growth"),
        )
        .orderBy(F.desc_nulls_last("total_revenue"), "service_name")
    )
