"""The trip fact, its daily and hourly aggregates, and roll-ups of those."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstar.functions import exact, temporal
from tripstar.operators.partials import reduce_trips

# Key used where a trip has none. The rate code defaults to the standard rate.
UNKNOWN_KEYS = {
    "pickup_location_id": ("pu_location_id", 0),
    "dropoff_location_id": ("do_location_id", 0),
    "vendor_id": ("vendor_id", 0),
    "payment_type_id": ("payment_type", 0),
    "ratecode_id": ("ratecode_id", 1),
    "trip_type_id": ("trip_type", 0),
    "store_fwd_flag": ("store_and_fwd_flag", " "),
}
MEASURE_COLUMNS = [
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "total_amount", "congestion_surcharge", "airport_fee", "ehail_fee",
]
DAILY_KEYS = ["date_key", "pickup_location_id", "dropoff_location_id", "file_type", "vendor_id"]
HOURLY_KEYS = ["date_key", "time_key", "file_type", "pickup_location_id"]
DAILY_MEASURES = ["passengers", "distance", "revenue", "tip", "fare", "duration"]
HOURLY_MEASURES = ["passengers", "distance", "revenue", "fare"]


def fact_trips(
    trips: DataFrame, year: int | None = None, month: int | None = None, keep: dict[str, Column] | None = None
) -> DataFrame:
    """Conformed trips as fact rows: smart keys, defaulted foreign keys, duration.

    With a year and month only that source month is projected; on a table
    partitioned by them this prunes the scan. ``keep`` adds columns of the trips.
    """
    if year is not None:
        trips = trips.filter(F.col("year") == year)
    if month is not None:
        trips = trips.filter(F.col("month") == month)
    return fact_columns(trips.filter(F.col("pickup_datetime").isNotNull()), keep)


def fact_columns(trips: DataFrame, keep: dict[str, Column] | None = None) -> DataFrame:
    """Trips under the columns of the fact, also those that are no rows of it for want of a pickup."""
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")

    def defaulted(key: str) -> Column:
        column, unknown = UNKNOWN_KEYS[key]
        return F.coalesce(F.col(column), F.lit(unknown)).alias(key)

    return trips.select(
        "trip_id",
        temporal.date_key(pickup).alias("pickup_date_key"),
        temporal.date_key(dropoff).alias("dropoff_date_key"),
        temporal.time_key(pickup).alias("pickup_time_key"),
        temporal.time_key(dropoff).alias("dropoff_time_key"),
        *[defaulted(key) for key in UNKNOWN_KEYS if key != "store_fwd_flag"],
        "file_type",
        defaulted("store_fwd_flag"),
        "passenger_count",
        "trip_distance",
        temporal.minutes_crossed(pickup, dropoff).alias("trip_duration_minutes"),
        *MEASURE_COLUMNS,
        "dispatching_base_num",
        "affiliated_base_number",
        "sr_flag",
        F.col("year").alias("source_year"),
        F.col("month").alias("source_month"),
        "processed_at",
        *[column.alias(name) for name, column in (keep or {}).items()],
    )


def not_yet_loaded(rows: DataFrame, loaded: DataFrame, key: str = "trip_id") -> DataFrame:
    """Rows whose key is not in the loaded table.

    The loaded side is cut to distinct keys, which the shuffle of the join reuses;
    a key repeated many times among the new rows is split by adaptive execution.
    """
    return rows.join(loaded.select(key).distinct(), key, "left_anti")


def derived_measures(fact: DataFrame) -> DataFrame:
    """Tip percentage, speed and revenue per mile of each trip, to two places."""
    cents = lambda c: exact.hundredths(F.col(c))
    fare, distance = cents("fare_amount"), cents("trip_distance")
    minutes = F.col("trip_duration_minutes")
    tip = exact.ratio2(cents("tip_amount") * 10000, fare)
    speed = exact.ratio2(distance * 60, minutes)
    per_mile = exact.ratio2(cents("total_amount") * 100, distance)
    return fact.withColumns(
        {
            "tip_percentage": F.when(F.col("fare_amount") > 0, tip).otherwise(0.0),
            "avg_speed_mph": F.when(minutes > 0, speed).otherwise(0.0),
            "revenue_per_mile": F.when(F.col("trip_distance") > 0, per_mile).otherwise(0.0),
        }
    )


def in_month(fact: DataFrame, year: int, month: int) -> DataFrame:
    """Fact rows picked up in a month: a range on the integer key, pushed to the scan."""
    return fact.filter(F.col("pickup_date_key").between(*temporal.month_range(year, month)))


def daily_agg(fact: DataFrame) -> DataFrame:
    """One row per day, route, service and vendor."""
    return daily_columns(reduce_trips(daily_rows(fact), DAILY_KEYS, DAILY_MEASURES))


def daily_rows(fact: DataFrame) -> DataFrame:
    """The trips that the daily aggregate counts, under its keys."""
    return fact.filter(
        F.col("pickup_location_id").isNotNull()
        & F.col("dropoff_location_id").isNotNull()
        & F.col("vendor_id").isNotNull()
    ).withColumnRenamed("pickup_date_key", "date_key")


def daily_columns(state: DataFrame) -> DataFrame:
    """The columns of the daily aggregate, from sums and counts per key."""
    tips_per_fare = F.when(
        F.col("sum_fare") > 0,
        F.col("sum_tip").cast("double") / F.col("sum_fare").cast("double") * 100,
    ).otherwise(0.0)
    return state.select(
        *DAILY_KEYS,
        F.col("trips").alias("total_trips"),
        F.col("sum_passengers").alias("total_passengers"),
        F.col("sum_distance").cast("decimal(12,2)").alias("total_distance"),
        F.col("sum_revenue").cast("decimal(15,2)").alias("total_revenue"),
        F.col("sum_tip").cast("decimal(12,2)").alias("total_tips"),
        _average("distance").alias("avg_trip_distance"),
        _average("fare").alias("avg_fare_amount"),
        tips_per_fare.alias("avg_tip_percentage"),
        _average("duration").alias("avg_trip_duration_minutes"),
    )


def hourly_agg(fact: DataFrame) -> DataFrame:
    """One row per day, hour, service and pickup place."""
    return hourly_columns(reduce_trips(hourly_rows(fact), HOURLY_KEYS, HOURLY_MEASURES))


def hourly_rows(fact: DataFrame) -> DataFrame:
    """The trips that the hourly aggregate counts, under its keys."""
    return fact.filter(
        F.col("pickup_time_key").isNotNull() & F.col("pickup_location_id").isNotNull()
    ).withColumns({
        "date_key": F.col("pickup_date_key"),
        "time_key": temporal.hour_bucket(F.col("pickup_time_key")),
    })


def hourly_columns(state: DataFrame) -> DataFrame:
    """The columns of the hourly aggregate, from sums and counts per key."""
    return state.select(
        *HOURLY_KEYS,
        F.col("trips").alias("total_trips"),
        F.col("sum_passengers").alias("total_passengers"),
        F.col("sum_distance").cast("decimal(12,2)").alias("total_distance"),
        F.col("sum_revenue").cast("decimal(15,2)").alias("total_revenue"),
        _average("distance").alias("avg_trip_distance"),
        _average("fare").alias("avg_fare_amount"),
    )


def _average(measure: str) -> Column:
    return exact.mean(F.col(f"sum_{measure}"), F.col(f"n_{measure}"))


# ---------------------------------------------------------------------------
# Roll-ups: counts and sums answered from the aggregates instead of the trips
# ---------------------------------------------------------------------------
def heatmap_from_hourly(hourly: DataFrame) -> DataFrame:
    """Trips per service, day of week (1 Sunday) and hour from the hourly aggregate."""
    day = F.make_date(
        F.floor(F.col("date_key") / 10000).cast("int"),
        (F.floor(F.col("date_key") / 100) % 100).cast("int"),
        (F.col("date_key") % 100).cast("int"),
    )
    return hourly.groupBy(
        "file_type",
        F.dayofweek(day).alias("day_of_week"),
        temporal.hour_of_key(F.col("time_key")).alias("hour"),
    ).agg(F.sum("total_trips").alias("trip_count"))


def daily_to_monthly(daily: DataFrame) -> DataFrame:
    """Trips, passengers, revenue and tips per service and month from the daily aggregate."""
    month = temporal.month_of_key(F.col("date_key"))
    return daily.groupBy(
        "file_type",
        F.floor(month / 100).cast("int").alias("year"),
        (month % 100).alias("month"),
    ).agg(
        F.sum("total_trips").alias("trip_count"),
        F.sum("total_passengers").alias("total_passengers"),
        F.sum("total_revenue").cast("decimal(20,2)").alias("total_revenue"),
        F.sum("total_tips").cast("decimal(20,2)").alias("total_tips"),
    )
