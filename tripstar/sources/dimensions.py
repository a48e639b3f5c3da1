"""The nine dimensions, and the two that are discovered from facts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.star import Star

# ---------------------------------------------------------------------------
# Members of the short dimensions.
# ---------------------------------------------------------------------------
LOCATIONS = [
    (0, "Unknown/Missing", "Unknown", "Unknown", "Unknown", False, False),
    (1, "EWR Airport", "EWR", "EWR", "Airport", True, False),
    (2, "Queens", "Queens", "Yellow", "Standard", False, False),
    (3, "Brooklyn", "Brooklyn", "Green", "Standard", False, False),
    (4, "Manhattan", "Manhattan", "Yellow", "Standard", False, True),
    (5, "Bronx", "Bronx", "Green", "Standard", False, False),
    (6, "Staten Island", "Staten Island", "Green", "Standard", False, False),
]
VENDORS = [
    (1, "Creative Mobile Technologies", "Taxi technology and payment processing provider",
     "Technology Provider", True),
    (2, "VeriFone Inc", "Taxi technology and payment processing provider",
     "Technology Provider", True),
    (3, "Other/Unknown Vendor", "Other or unspecified technology vendor", "Other", True),
    (0, "Not Specified", "Vendor information not provided", "Unknown", True),
]
PAYMENT_TYPES = [
    (1, "Credit Card", "Electronic", True),
    (2, "Cash", "Cash", False),
    (3, "No Charge", "Other", True),
    (4, "Dispute", "Other", True),
    (5, "Unknown", "Other", True),
    (6, "Voided Trip", "Other", True),
    (0, "Not Specified", "Other", True),
]
RATE_CODES = [
    (1, "Standard Rate", "Standard", False, "1.00"),
    (2, "JFK Airport", "Airport", True, "1.00"),
    (3, "Newark Airport", "Airport", True, "1.00"),
    (4, "Nassau or Westchester", "Outer Borough", False, "1.00"),
    (5, "Negotiated Fare", "Special", False, "1.00"),
    (6, "Group Ride", "Special", False, "1.00"),
    (99, "Unknown", "Other", False, "1.00"),
    (0, "Not Specified", "Other", False, "1.00"),
]
TRIP_TYPES = [
    (1, "Street Hail", "Hail"),
    (2, "Dispatch", "Dispatch"),
    (0, "Not Specified", "Unknown"),
]
FILE_SOURCES = [
    ("yellow", "Yellow Taxi",
     "Traditional yellow medallion taxis operating primarily in Manhattan and airports",
     "Taxi", "Medallion"),
    ("green", "Green Taxi",
     "Street hail livery vehicles (Boro Taxis) operating outside Manhattan core",
     "Taxi", "Street Hail Livery"),
    ("fhv", "For-Hire Vehicle",
     "App-based ride services, livery vehicles, and other for-hire transportation",
     "FHV", "For-Hire Vehicle"),
]
STORE_FWD_FLAGS = [
    ("Y", "Store and Forward - Trip record held in vehicle memory before sending to vendor"),
    ("N", "Not Store and Forward - Trip record sent immediately to vendor"),
    (" ", "Not Specified"),
]
CALENDAR = (date(2009, 1, 1), date(2030, 12, 31))

SCHEMAS = {
    "dim_location": "location_id int, zone_name string, borough string, service_zone string, "
    "location_type string, is_airport boolean, is_manhattan boolean",
    "dim_vendor": "vendor_id int, vendor_name string, vendor_description string, "
    "vendor_category string, is_active boolean",
    "dim_payment_type": "payment_type_id int, payment_method string, payment_category string, "
    "is_cashless boolean",
    "dim_rate_code": "ratecode_id int, rate_description string, rate_category string, "
    "is_airport_rate boolean, multiplier string",
    "dim_trip_type": "trip_type_id int, trip_description string, trip_category string",
    "dim_file_source": "file_type string, service_name string, service_description string, "
    "service_category string, regulation_type string",
    "dim_store_fwd_flag": "store_fwd_flag string, flag_description string",
}
MEMBERS = {
    "dim_location": LOCATIONS,
    "dim_vendor": VENDORS,
    "dim_payment_type": PAYMENT_TYPES,
    "dim_rate_code": RATE_CODES,
    "dim_trip_type": TRIP_TYPES,
    "dim_file_source": FILE_SOURCES,
    "dim_store_fwd_flag": STORE_FWD_FLAGS,
}


def short_dimension(spark: SparkSession, name: str) -> DataFrame:
    """One of the seven dimensions that are plain lists."""
    names = [column.split()[0] for column in SCHEMAS[name].split(", ")]
    rows = ", ".join(
        "(" + ", ".join(_literal(value) for value in member) + ")" for member in MEMBERS[name]
    )
    table = spark.sql(f"SELECT * FROM VALUES {rows} AS t({', '.join(names)})")
    if name == "dim_rate_code":
        table = table.withColumn("multiplier", F.col("multiplier").cast("decimal(3,2)"))
    return table


def _literal(value: object) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    return str(value) if isinstance(value, int) else "'" + str(value) + "'"


# ---------------------------------------------------------------------------
# Calendar and clock
# ---------------------------------------------------------------------------
def calendar(
    spark: SparkSession, start: date = CALENDAR[0], end: date = CALENDAR[1]
) -> DataFrame:
    """Calendar dimension for a fixed range of days."""
    bounds = spark.range(1).select(F.lit(start).alias("first"), F.lit(end).alias("last"))
    return calendar_between(bounds)


def calendar_between(bounds: DataFrame) -> DataFrame:
    """Calendar dimension from a one-row frame with dates ``first`` and ``last``.

    Days of the week run from 1 for Sunday to 7 for Saturday.
    """
    d = F.col("full_date")
    return _days(bounds).select(
        (F.year(d) * 10000 + F.month(d) * 100 + F.day(d)).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.day(d).alias("day"),
        F.quarter(d).alias("quarter"),
        F.dayofweek(d).alias("day_of_week"),
        F.dayname(d).alias("day_name"),
        F.monthname(d).alias("month_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        F.weekofyear(d).alias("week_of_year"),
    )


def iso_calendar_between(bounds: DataFrame) -> DataFrame:
    """Calendar with ISO days of the week (1 Monday .. 7 Sunday) and long names."""
    d = F.col("full_date")
    iso_day = F.weekday(d) + 1
    return _days(bounds).select(
        d.alias("date_id"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.day(d).alias("day"),
        iso_day.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        (iso_day >= 6).alias("is_weekend"),
    )


def calendar_since_first_month(summary: DataFrame, as_of: date) -> DataFrame:
    """ISO calendar from the first month of a monthly summary up to ``as_of``."""
    first = F.min(F.make_date("year", "month", F.lit(1)))
    bounds = summary.agg(first.alias("first")).withColumn("last", F.lit(as_of))
    return iso_calendar_between(bounds.filter("first <= last"))


def _days(bounds: DataFrame) -> DataFrame:
    span = F.sequence("first", "last", F.expr("interval 1 day"))
    return bounds.select(F.explode(span).alias("full_date"))


def clock(spark: SparkSession) -> DataFrame:
    """Time dimension: the 1440 minutes of a day."""
    minutes = spark.range(0, 1440, numPartitions=1).select(
        F.floor(F.col("id") / 60).cast("int").alias("hour"),
        (F.col("id") % 60).cast("int").alias("minute"),
    )
    hour, minute = F.col("hour"), F.col("minute")
    return minutes.select(
        (hour * 100 + minute).alias("time_key"),
        hour,
        minute,
        F.concat_ws(":", _two_digits(hour), _two_digits(minute)).alias("hour_minute"),
        time_period(hour).alias("time_period"),
        (hour.between(7, 9) | hour.between(17, 19)).alias("rush_hour_flag"),
        hour.between(9, 17).alias("business_hours_flag"),
    )


def _two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def time_period(hour: Column) -> Column:
    """Name of the part of the day an hour falls in."""
    # Last hour of each named period, from 5 o'clock on.
    periods = [(8, "Early Morning"), (11, "Morning"), (16, "Afternoon"), (20, "Evening")]
    named = F.when(hour < 5, "Night")
    for last_hour, name in periods:
        named = named.when(hour <= last_hour, name)
    return named.otherwise("Night")


# ---------------------------------------------------------------------------
# Dimensions and facts together
# ---------------------------------------------------------------------------
def build_star(
    spark: SparkSession,
    fact_trips: DataFrame,
    start: date = CALENDAR[0],
    end: date = CALENDAR[1],
    dim_location: DataFrame | None = None,
) -> Star:
    """Star around a trip fact; a larger location table may be supplied."""
    short = {name: short_dimension(spark, name) for name in MEMBERS}
    supplied = frozenset()
    if dim_location is not None:
        short["dim_location"] = dim_location
        supplied = frozenset({"dim_location"})
    return Star(
        fact_trips=fact_trips,
        dim_date=calendar(spark, start, end),
        dim_time=clock(spark),
        supplied=supplied,
        **short,
    )


def discovered_locations(routes: DataFrame) -> DataFrame:
    """Location members seen in routes; one seen at both ends counts as a pickup.

    Both roles come from one pass, and the smallest role wins within each id.
    """
    ends = routes.select(
        F.explode(
            F.array(
                F.struct(F.col("pickup_location_id").alias("id"), F.lit(1).alias("role")),
                F.struct(F.col("dropoff_location_id").alias("id"), F.lit(2).alias("role")),
            )
        ).alias("end")
    )
    return (
        ends.filter(F.col("end.id").isNotNull())
        .groupBy(F.col("end.id").alias("location_id"))
        .agg(F.min("end.role").alias("role"))
        .select(
            "location_id",
            F.when(F.col("role") == 1, "pickup").otherwise("dropoff").alias("location_type"),
            F.lit(None).cast("string").alias("borough"),
            F.lit(None).cast("string").alias("zone"),
        )
    )


def member_usage(dim: DataFrame, fact: DataFrame, roles: dict[str, str]) -> DataFrame:
    """Dimension members with the number of fact rows that refer to them, per role.

    ``roles`` maps a new column to the fact's key column. The fact is counted per
    key before it meets the dimension.
    """
    result, key = dim, dim.columns[0]
    for name, column in roles.items():
        used = fact.groupBy(F.col(column).alias(key)).agg(F.count(F.lit(1)).alias(name))
        result = result.join(used, key, "left").fillna(0, [name])
    return result
