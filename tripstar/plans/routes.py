"""Second-level analysis of the top routes mart (at most its row limit)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstar.functions import exact, labels

ROUTE = ["pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone", "service_name"]
METRICS = ["trip_count", "total_revenue", "avg_revenue", "avg_distance", "avg_duration"]


def top_n_by_metric(
    routes: DataFrame, metrics: str | list[str] = "trip_count", n: int = 15
) -> DataFrame:
    """The ``n`` routes that lead in each given metric, labelled, with rank marks."""
    chosen = [metrics] if isinstance(metrics, str) else metrics
    unknown = set(chosen) - set(METRICS)
    if unknown:
        raise ValueError(f"unknown metrics {sorted(unknown)}")
    marks = {
        "volume_mark": labels.rank_label(F.col("route_rank_by_volume")),
        "revenue_mark": labels.rank_label(F.col("route_rank_by_revenue")),
        "route_label": labels.arrow(F.col("pickup_zone"), F.col("dropoff_zone")),
    }
    return _leaders(routes.withColumns(marks), chosen, n).select(
        "metric", "route_label", *ROUTE, "value", "volume_mark", "revenue_mark"
    )


def _leaders(routes: DataFrame, metrics: list[str], n: int) -> DataFrame:
    """The first ``n`` routes by each metric in one pass over the routes."""
    values = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
            for m in metrics
        ]
    )
    by_value = Window.partitionBy("metric").orderBy(F.desc_nulls_last("value"), *ROUTE)
    return (
        routes.withColumn("m", F.explode(values))
        .select("*", "m.metric", "m.value")
        .withColumn("position", F.row_number().over(by_value))
        .filter(F.col("position") <= n)
    )


def borough_flow(routes: DataFrame) -> DataFrame:
    """Trips and revenue between boroughs, with node numbers 0.. in name order."""
    flows = routes.groupBy("pickup_borough", "dropoff_borough").agg(
        F.sum("trip_count").alias("trip_count"), F.sum("total_revenue").alias("total_revenue")
    )
    everything = Window.partitionBy()  # one row per pair of boroughs
    names = F.array_sort(
        F.array_union(
            F.collect_set("pickup_borough").over(everything),
            F.collect_set("dropoff_borough").over(everything),
        )
    )
    number = lambda c: (F.array_position("nodes", F.col(c)) - 1).cast("int")
    return flows.withColumn("nodes", names).select(
        "pickup_borough", "dropoff_borough",
        number("pickup_borough").alias("source"), number("dropoff_borough").alias("target"),
        "trip_count", "total_revenue",
    )


def service_stats(routes: DataFrame) -> DataFrame:
    """Totals and unweighted means of the routes of each service."""
    mean = lambda c: F.round(F.avg(c), 2).alias(c)
    return routes.groupBy("service_name").agg(
        F.sum("trip_count").alias("trip_count"),
        F.sum("total_revenue").alias("total_revenue"),
        mean("avg_revenue"), mean("avg_distance"), mean("avg_duration"),
    )


def insights(routes: DataFrame) -> DataFrame:
    """Busiest route, most profitable route, top pickup borough, service with most routes.

    Borough and service totals are put next to each route, so that one aggregation
    finds all four.
    """
    rows = routes.withColumns({
        "b_trips": F.sum("trip_count").over(Window.partitionBy("pickup_borough")),
        "s_routes": F.count(F.lit(1)).over(Window.partitionBy("service_name")),
    })
    names = [F.col(c) for c in ROUTE]
    route = labels.arrow(F.col("pickup_zone"), F.col("dropoff_zone"))

    def lead(kind: str, label: Column, value: str, other: Column, ties: list[Column]) -> Column:
        found = F.struct(
            F.lit(kind).alias("insight"), label.alias("label"),
            F.col(value).cast("double").alias("value"), other.cast("double").alias("other"),
        )
        order = F.when(F.col(value).isNotNull(), F.struct(-F.col(value), *ties))
        return F.min_by(found, order)

    nothing = F.lit(None)
    found = F.array(
        lead("busiest_route", route, "trip_count", F.col("total_revenue"), names),
        lead("most_profitable_route", route, "total_revenue", F.col("trip_count"), names),
        lead("top_pickup_borough", F.col("pickup_borough"), "b_trips", nothing,
             [F.col("pickup_borough")]),
        lead("dominant_service", F.col("service_name"), "s_routes", nothing,
             [F.col("service_name")]),
    )
    return rows.agg(found.alias("found")).select(F.inline(F.array_compact("found")))


def totals(routes: DataFrame) -> DataFrame:
    return routes.agg(
        F.count(F.lit(1)).alias("total_routes"),
        F.sum("trip_count").alias("total_trips"),
        F.sum("total_revenue").alias("total_revenue"),
        exact.mean(F.sum("total_revenue"), F.count("total_revenue")).alias("avg_route_revenue"),
    )


def borough_performance(routes: DataFrame) -> DataFrame:
    return (
        routes.groupBy("pickup_borough")
        .agg(
            F.sum("trip_count").alias("trip_count"),
            F.sum("total_revenue").alias("total_revenue"),
        )
        .orderBy(F.desc("trip_count"), "pickup_borough")
    )


def with_efficiency(routes: DataFrame) -> DataFrame:
    """Revenue per mile and per minute of a route's averages; NULL where the base is 0."""
    per = lambda c: exact.stable(
        F.col("avg_revenue") / F.nullif(F.col(c), F.lit(0.0))
    )
    return routes.withColumns(
        {"revenue_per_mile": per("avg_distance"), "revenue_per_minute": per("avg_duration")}
    )


def efficiency(routes: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most efficient routes by mile and by minute."""
    leaders = _leaders(with_efficiency(routes), ["revenue_per_mile", "revenue_per_minute"], n)
    return leaders.select(F.col("metric").alias("measure"), *ROUTE, "value")
