"""Second-level analysis of the airport traffic mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstar.functions import exact, labels

FROM, TO = "From Airport", "To Airport"


def _airport_trips(traffic: DataFrame) -> DataFrame:
    return traffic.filter(F.col("trip_type").isin(FROM, TO))


def _sum(column: str) -> Column:
    return F.sum(column).alias(column)


def _mean(column: str, digits: int = 6) -> Column:
    return F.round(F.avg(column), digits).alias(column)


def headline(traffic: DataFrame) -> DataFrame:
    """Totals over all airports and how trips split by direction."""
    rows = _airport_trips(traffic)
    counts = lambda kind: F.coalesce(
        F.sum(F.when(F.col("trip_type") == kind, F.col("trip_count"))), F.lit(0)
    )
    return rows.agg(
        F.sum("trip_count").alias("total_trips"),
        F.sum("total_revenue").alias("total_revenue"),
        exact.stable(F.avg("avg_fare")).alias("avg_fare"),
        F.countDistinct("airport_name").alias("airports_served"),
        counts(FROM).alias("from_trips"),
        counts(TO).alias("to_trips"),
        exact.percent(counts(FROM), F.sum("trip_count")).alias("from_pct"),
        exact.percent(counts(TO), F.sum("trip_count")).alias("to_pct"),
    )


def by_direction(traffic: DataFrame) -> DataFrame:
    return _airport_trips(traffic).groupBy("airport_name", "trip_type").agg(
        _sum("trip_count"), _sum("total_revenue"), _mean("avg_fare")
    )


def performance(traffic: DataFrame) -> DataFrame:
    """Airports by traffic, with their band and trips per direction."""
    directed = lambda kind: F.coalesce(
        F.sum(F.when(F.col("trip_type") == kind, F.col("trip_count"))), F.lit(0)
    )
    return (
        _airport_trips(traffic)
        .groupBy("airport_name")
        .agg(
            _sum("trip_count"), _sum("total_revenue"), _mean("avg_fare", 2),
            _mean("avg_distance", 2), _mean("avg_duration", 2),
            directed(FROM).alias("from_trips"), directed(TO).alias("to_trips"),
        )
        .withColumn("band", labels.traffic_band(F.col("trip_count")))
        .orderBy(F.desc("trip_count"), "airport_name")
    )


def time_patterns(traffic: DataFrame) -> DataFrame:
    """Trips and mean fare per part of day: by direction, and together as ``All``."""
    both = F.explode(F.array(F.col("trip_type"), F.lit("All")))
    return (
        _airport_trips(traffic)
        .withColumn("trip_type", both)
        .groupBy("time_period", "trip_type")
        .agg(_sum("trip_count"), _mean("avg_fare"))
    )


def service_share(traffic: DataFrame) -> DataFrame:
    """Airport trips per service and their share of all airport trips."""
    services = _airport_trips(traffic).groupBy("service_name").agg(
        _sum("trip_count"), _sum("total_revenue"), _mean("avg_fare", 2),
        _mean("avg_distance", 2),
    )
    everything = F.sum("trip_count").over(Window.partitionBy())  # one row per service
    return services.withColumn(
        "share_pct", exact.percent(F.col("trip_count"), everything)
    ).orderBy(F.desc("trip_count"), "service_name")


def recent_months(traffic: DataFrame, n: int = 6) -> DataFrame:
    """Airport trips of the last ``n`` months, oldest first."""
    months = (
        _airport_trips(traffic)
        .groupBy("year", "month_name")
        .agg(_sum("trip_count"), _sum("total_revenue"), _mean("avg_fare"))
        .withColumn("month", labels.month_number(F.col("month_name")))
    )
    last = months.orderBy(F.desc("year"), F.desc("month")).limit(n)
    return last.select(
        "year", "month", labels.period_label(F.col("year"), F.col("month_name")).alias("period"),
        "trip_count", "total_revenue", "avg_fare",
    ).orderBy("year", "month")
