"""Monthly summaries built straight from the conformed trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstar.functions import exact, temporal

MONTH = ["year", "month", "file_type"]
ROUTE = [*MONTH, "pickup_location_id", "dropoff_location_id"]


_MICROS_PER_MINUTE = 60_000_000


def _ride_micros() -> Column:
    micros = temporal.elapsed_micros(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return micros.cast("decimal(18,0)")  # wide enough for the sum over any month


def _averages(rounded: bool) -> list[Column]:
    """Mean distance and mean elapsed minutes with fractions."""
    distance = (F.sum("trip_distance"), F.count("trip_distance"))
    ride = (F.sum(_ride_micros()), F.count(_ride_micros()))
    if rounded:
        values = exact.mean2(*distance), exact.mean2(*ride, unit=_MICROS_PER_MINUTE)
    else:
        values = exact.mean(*distance), exact.mean(*ride) / _MICROS_PER_MINUTE
    return [values[0].alias("avg_trip_distance"), values[1].alias("avg_trip_time")]


def _measures(rounded: bool) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_trips"),
        F.sum("passenger_count").alias("total_passengers"),
        *_averages(rounded),
        F.sum("fare_amount").cast("decimal(18,2)").alias("total_fare"),
        F.sum("tip_amount").cast("decimal(18,2)").alias("total_tips"),
        F.sum("total_amount").cast("decimal(18,2)").alias("total_amount"),
    ]


def trip_summary(
    trips: DataFrame, year: int | None = None, month: int | None = None
) -> DataFrame:
    """Trips, passengers, averages and totals per file month and service."""
    return _only(trips, year, month).groupBy(*MONTH).agg(*_measures(rounded=True))


def trip_summary_by_event_month(trips: DataFrame) -> DataFrame:
    """The same measures, unrounded, by the month of the pickup itself."""
    pickup = F.col("pickup_datetime")
    by = [F.year(pickup).alias("year"), F.month(pickup).alias("month"), "file_type"]
    return trips.groupBy(*by).agg(*_measures(rounded=False))


def fare_summary(
    trips: DataFrame, year: int | None = None, month: int | None = None
) -> DataFrame:
    """Money totals per file month and service.

    A trip that lacks any of the four surcharges adds nothing to their total.
    """
    surcharges = (
        F.col("improvement_surcharge")
        + F.col("mta_tax")
        + F.col("congestion_surcharge")
        + F.col("airport_fee")
    )
    totals = {
        "total_fare": F.col("fare_amount"),
        "total_tips": F.col("tip_amount"),
        "total_tolls": F.col("tolls_amount"),
        "total_surcharges": surcharges,
        "total_amount": F.col("total_amount"),
    }
    return (
        _only(trips, year, month)
        .groupBy(*MONTH)
        .agg(*[F.sum(c).cast("decimal(38,2)").alias(name) for name, c in totals.items()])
    )


def fare_summary_preview(trips: DataFrame, rows: int = 20) -> DataFrame:
    """The first months of the fare summary."""
    return fare_summary(trips).orderBy(*MONTH).limit(rows)


def trip_locations(
    trips: DataFrame, year: int | None = None, month: int | None = None
) -> DataFrame:
    """Trips, averages and revenue per route, file month and service."""
    return (
        _only(trips, year, month)
        .withColumnsRenamed(
            {"pu_location_id": "pickup_location_id", "do_location_id": "dropoff_location_id"}
        )
        .groupBy(*ROUTE)
        .agg(
            F.count(F.lit(1)).alias("total_trips"),
            *_averages(rounded=True),
            F.sum("total_amount").cast("decimal(38,2)").alias("total_amount"),
        )
    )


def trip_locations_top(trips: DataFrame, rows: int = 10) -> DataFrame:
    """The busiest routes of the earliest months, ties in key order."""
    order = ["year", "month", F.desc("total_trips"), "file_type"]
    ends = [F.asc_nulls_first("pickup_location_id"), F.asc_nulls_first("dropoff_location_id")]
    return trip_locations(trips).orderBy(*order, *ends).limit(rows)


def known_places(trips: DataFrame) -> DataFrame:
    """Trips with both ends known, the ones a full route load keeps."""
    return trips.filter(
        F.col("pu_location_id").isNotNull() & F.col("do_location_id").isNotNull()
    )


def _only(trips: DataFrame, year: int | None, month: int | None) -> DataFrame:
    if year is not None:
        trips = trips.filter(F.col("year") == year)
    if month is not None:
        trips = trips.filter(F.col("month") == month)
    return trips
