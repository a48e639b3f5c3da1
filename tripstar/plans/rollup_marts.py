"""Marts answered from stored aggregates alone: activity of services, routes and vendors, quantiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstar.functions import temporal
from tripstar.operators import rollups
from tripstar.star import Star

_ROUTE = ["pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone"]


def monthly_actives(sets: DataFrame) -> DataFrame:
    """Active days, places and vendors per month, of each service and of all together."""
    month = temporal.month_of_key(F.col("date_key"))
    dated = sets.withColumns({"year": F.floor(month / 100).cast("int"), "month": (month % 100).cast("int")})
    names = {"days": "active_days", "pickup_places": "pickup_places", "dropoff_places": "dropoff_places", "vendors": "vendors"}
    # the sets of services are merged first, so those of all are merged from few rows
    by = ["file_type", "year", "month"]
    own = dated.groupBy(*by, "kind", "span").agg(F.bitmap_or_agg("members").alias("members"))
    everything = own.withColumn("file_type", F.lit("all"))
    return rollups.distinct_counts(own, by, names).unionByName(rollups.distinct_counts(everything, by, names))


def service_activity(star: Star, sets: DataFrame) -> DataFrame:
    """Operating days and active vendors of each service."""
    named = star.attach(sets, "dim_file_source", "file_type", {"service_name": "service_name"})
    names = {"days": "operating_days", "vendors": "active_vendors", "pickup_places": "places_served"}
    return rollups.distinct_counts(named, ["service_name"], names)


def route_activity(star: Star, daily: DataFrame) -> DataFrame:
    """Active days of each named route and service."""
    keys = ["pickup_location_id", "dropoff_location_id", "file_type"]
    sets = rollups.member_sets(daily, keys, rollups.active_days())
    for end in ("pickup", "dropoff"):
        names = {f"{end}_borough": "borough", f"{end}_zone": "zone_name"}
        sets = star.attach(sets, "dim_location", f"{end}_location_id", names)
    named = star.attach(sets, "dim_file_source", "file_type", {"service_name": "service_name"})
    return rollups.distinct_counts(named, [*_ROUTE, "service_name"], {"days": "active_days"})


def vendor_activity(star: Star, daily: DataFrame) -> DataFrame:
    """Operating days and places of each vendor, service and month."""
    month = temporal.month_of_key(F.col("date_key"))
    known = daily.filter(F.col("vendor_id") != 0).withColumns(
        {"year": F.floor(month / 100).cast("int"), "month": (month % 100).cast("int")}
    )
    members = {**rollups.active_days(), "pickup_places": F.col("pickup_location_id")}
    sets = rollups.member_sets(known, ["vendor_id", "file_type", "year", "month"], members)
    sets = star.attach(sets, "dim_vendor", "vendor_id", {"vendor_name": "vendor_name"})
    named = star.attach(sets, "dim_file_source", "file_type", {"service_name": "service_name"})
    names = {"days": "operating_days", "pickup_places": "coverage_locations"}
    return rollups.distinct_counts(named, ["vendor_name", "service_name", "year", "month"], names)


def weekly_slots(counts: DataFrame) -> DataFrame:
    """Counts by class under the day of week (1 Sunday) and hour of their slot."""
    day = F.date_from_unix_date(rollups.day_number(F.col("date_key")))
    return counts.withColumns({"day_of_week": F.dayofweek(day), "hour": temporal.hour_of_key(F.col("time_key"))})


def rank_errors(fact: DataFrame, found: DataFrame, percents: list[int]) -> DataFrame:
    """Largest rank error, in hundredths of a percent of a slot's trips, of each service.

    The error of an estimate is how far the ranks that its value takes lie from the wanted one.
    """
    day = F.date_from_unix_date(rollups.day_number(F.col("pickup_date_key")))
    cents = F.rint(F.col("total_amount").cast("double") * 100).cast("bigint")
    by = ["file_type", "day_of_week", "hour"]
    trips = fact.select(
        "file_type", F.dayofweek(day).alias("day_of_week"), temporal.hour_of_key(F.col("pickup_time_key")).alias("hour"), cents.alias("cents")
    )
    middles = [rollups.middle(F.col(f"p{p}")).alias(f"e{p}") for p in percents]
    counted = trips.filter("cents IS NOT NULL").join(found.select(*by, "n", *middles), by)
    counts = [F.count_if(F.col("cents") < F.col(f"e{p}")).alias(f"below{p}") for p in percents]
    counts += [F.count_if(F.col("cents") <= F.col(f"e{p}")).alias(f"upto{p}") for p in percents]
    ranked = counted.groupBy(*by).agg(F.first("n").alias("n"), *counts)
    errors = []
    for p in percents:
        wanted = F.greatest(F.call_function("div", F.col("n") * p + 99, F.lit(100)), F.lit(1))
        off = F.greatest(F.col(f"below{p}") + 1 - wanted, wanted - F.greatest(F.col(f"upto{p}"), F.lit(1)), F.lit(0))
        errors.append(F.max(F.call_function("div", off * 10000, F.col("n"))).alias(f"p{p}_error"))
    return ranked.groupBy("file_type").agg(F.count(F.lit(1)).alias("slots"), *errors)
