"""Aggregates of aggregates that plain sums cannot give: distinct counts and quantiles.

Distinct counts rest on exact bitmaps, quantiles on counts of values by narrow classes. Both
are tables of small rows that merge by key: those of days give those of months, places or
services, and neither the trips nor the values are read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstar.functions import temporal

# ---------------------------------------------------------------------------
# Distinct counts
# ---------------------------------------------------------------------------
SET_KEYS = ["date_key", "file_type"]


def day_number(key: Column) -> Column:
    """Days since 1970 of a ``YYYYMMDD`` key."""
    parts = [F.floor(key / 10000), F.floor(key / 100) % 100, key % 100]
    return F.unix_date(F.make_date(*[p.cast("int") for p in parts]))


def active_days() -> dict[str, Column]:
    return {"days": day_number(F.col("date_key"))}


def member_sets(rows: DataFrame, keys: list[str], members: dict[str, Column]) -> DataFrame:
    """For each key and kind of member, the set of its values as bitmaps.

    A bitmap spans 32 768 neighbouring values; a set has one row per span that it touches.
    NULL is no member. Bits are set inside the tasks, so a hot key is reduced before the shuffle.
    """
    kinds = [F.struct(F.lit(k).alias("kind"), v.cast("bigint").alias("value")) for k, v in members.items()]
    values = rows.select(*keys, F.explode(F.array(*kinds)).alias("_m")).select(*keys, "_m.kind", "_m.value")
    return (
        values.filter(F.col("value").isNotNull())
        .groupBy(*keys, "kind", F.bitmap_bucket_number("value").alias("span"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("value")).alias("members"))
    )


def daily_sets(daily: DataFrame) -> DataFrame:
    """Days, places and vendors of every day and service, from the daily aggregate alone."""
    members = {
        **active_days(),
        "pickup_places": F.col("pickup_location_id"),
        "dropoff_places": F.col("dropoff_location_id"),
        "vendors": F.col("vendor_id"),
    }
    return member_sets(daily, SET_KEYS, members)


def distinct_counts(sets: DataFrame, by: list[str], names: dict[str, str]) -> DataFrame:
    """Numbers of distinct members after sets are merged by other columns.

    ``names`` maps kinds of members to columns; a key without members of a kind has 0.
    """
    wanted = sets.filter(F.col("kind").isin(*names))
    merged = wanted.groupBy(*by, "kind", "span").agg(F.bitmap_count(F.bitmap_or_agg("members")).alias("n"))
    counts = [
        F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).alias(name) for kind, name in names.items()
    ]
    return merged.groupBy(*by).agg(*counts)


# ---------------------------------------------------------------------------
# Quantiles
# ---------------------------------------------------------------------------
PRECISION = 7  # classes per doubling of the value: 2**PRECISION
SLOT_KEYS = ["date_key", "time_key", "file_type"]


def class_width(value: Column, precision: int = PRECISION) -> Column:
    """Width of the class of a whole number; its share of the value is at most ``2**-precision``."""
    bits = F.length(F.bin(F.abs(value)))
    return F.pow(F.lit(2.0), F.greatest(bits - (precision + 1), F.lit(0))).cast("bigint")


def value_class(value: Column, precision: int = PRECISION) -> Column:
    """The class of a whole number, named by its value nearest to 0. Classes keep the order of values."""
    return value - value % class_width(value, precision)


def value_counts(rows: DataFrame, keys: list[str], value: Column, precision: int = PRECISION) -> DataFrame:
    """Number of values by key and class; NULL is no value. Adds up by any coarser key.

    The number of classes is bounded by the precision, whatever the number of rows, and
    counts may be subtracted again, so late and removed rows need no second pass.
    """
    classed = rows.select(*keys, value_class(value.cast("bigint"), precision).alias("class"))
    return classed.filter(F.col("class").isNotNull()).groupBy(*keys, "class").agg(F.count(F.lit(1)).alias("n"))


def slot_revenue(fact: DataFrame) -> DataFrame:
    """Revenue in cents by class for every day, hour and service."""
    cents = F.rint(F.col("total_amount").cast("double") * 100).cast("bigint")
    rows = fact.select(
        F.col("pickup_date_key").alias("date_key"),
        temporal.hour_bucket(F.col("pickup_time_key")).alias("time_key"),
        "file_type",
        cents.alias("cents"),
    )
    return value_counts(rows, SLOT_KEYS, F.col("cents"))


def quantiles(counts: DataFrame, by: list[str], percents: list[int]) -> DataFrame:
    """``n`` and for each percent the class that holds the quantile, after merging by other columns.

    The quantile is the value at rank ``ceil(percent * n / 100)``. As classes keep the order of
    values, it lies in the class found, without error of rank; within the class it is unknown.
    """
    merged = counts.groupBy(*by, "class").agg(F.sum("n").alias("n"))
    up_to = Window.partitionBy(*by).orderBy("class")  # a key has a bounded number of classes
    ranked = merged.withColumns(
        {"_upto": F.sum("n").over(up_to), "_all": F.sum("n").over(Window.partitionBy(*by))}
    )

    def found(percent: int) -> Column:
        rank = F.greatest(F.call_function("div", F.col("_all") * percent + 99, F.lit(100)), F.lit(1))
        return F.min(F.when(F.col("_upto") >= rank, F.col("class"))).alias(f"p{percent}")

    return ranked.groupBy(*by).agg(F.first("_all").alias("n"), *[found(p) for p in percents])


def middle(found: Column, precision: int = PRECISION) -> Column:
    """The middle of a class, as the estimate of a value in it."""
    half = F.call_function("div", class_width(found, precision) - 1, F.lit(2))
    return found + F.when(found < 0, -half).otherwise(half)
