"""Mergeable aggregates.

A mart first reduces the fact on narrow integer keys, then attaches dimension
attributes to the few resulting rows and merges them by attribute. The state
kept per measure is a sum and a count of non-null values, so merging is exact,
text attributes are never carried per trip, and a key that holds a large share
of all trips is reduced inside each task before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstar.functions import exact

_COLUMNS = {
    "revenue": "total_amount",
    "fare": "fare_amount",
    "tip": "tip_amount",
    "tolls": "tolls_amount",
    "congestion": "congestion_surcharge",
    "passengers": "passenger_count",
    "distance": "trip_distance",
    "duration": "trip_duration_minutes",
}


def measure(name: str) -> Column:
    """The value of a measure for one trip."""
    if name == "tip_percent":
        fare = F.col("fare_amount").cast("double")
        return F.when(
            F.col("fare_amount") > 0, F.col("tip_amount").cast("double") / fare * 100
        ).otherwise(0.0)
    if name == "speed":
        minutes = F.col("trip_duration_minutes")
        return F.when(
            minutes > 0, F.col("trip_distance").cast("double") * 60 / minutes
        ).otherwise(0.0)
    return F.col(_COLUMNS[name])


# Sums of floating ratios depend on the order of summation in the last digits.
_FLOATING = {"tip_percent", "speed"}


def reduce_trips(
    trips: DataFrame, keys: list[str | Column], measures: list[str], **counts: Column
) -> DataFrame:
    """Reduce trips to one row per key combination.

    Adds ``trips``, ``sum_<m>`` and ``n_<m>`` per measure, and for each extra
    keyword the number of trips its condition holds for.
    """
    state = [F.count(F.lit(1)).alias("trips")]
    for name in measures:
        state += [F.sum(measure(name)).alias(f"sum_{name}")]
        state += [F.count(measure(name)).alias(f"n_{name}")]
    state += [F.count_if(condition).alias(name) for name, condition in counts.items()]
    return trips.groupBy(*keys).agg(*state)


def signed(rows: DataFrame, keys: list[str], measures: list[str], sign: str) -> DataFrame:
    """The state of :func:`reduce_trips` with each row counted by its sign, 1 or -1."""
    state = [F.sum(F.col(sign).cast("bigint")).alias("trips")]
    for name in measures:
        value = measure(name)
        state += [F.sum(F.when(F.col(sign) > 0, value).otherwise(-value)).alias(f"sum_{name}")]
        state += [F.sum(F.when(value.isNotNull(), F.col(sign).cast("bigint")).otherwise(0)).alias(f"n_{name}")]
    return rows.groupBy(*keys).agg(*state)


def add_up(states: DataFrame, keys: list[str]) -> DataFrame:
    """States of the same key added up; a sum of which no value is left is NULL again."""
    totals = states.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in states.columns if c not in keys])
    sums = [c.removeprefix("sum_") for c in totals.columns if c.startswith("sum_")]
    types = dict(states.dtypes)
    return totals.withColumns(
        {f"sum_{m}": F.when(F.col(f"n_{m}") != 0, F.col(f"sum_{m}").cast(types[f"sum_{m}"])) for m in sums}
    )


def merge(
    reduced: DataFrame, by: list[str], measures: list[str], *others: str, **more: Column
) -> DataFrame:
    """Merge reduced rows by other columns; ``others`` are extra counts to add up."""
    names = ["trips", *others]
    for name in measures:
        names += [f"sum_{name}", f"n_{name}"]
    return reduced.groupBy(*by).agg(
        *[F.sum(name).alias(name) for name in names],
        *[column.alias(name) for name, column in more.items()],
    )


def total(name: str) -> Column:
    """Sum of a measure; money keeps its two decimals."""
    column = F.col(f"sum_{name}")
    return column if name in _FLOATING | {"passengers", "duration"} else column.cast(
        "decimal(20,2)"
    )


def average(name: str) -> Column:
    """Mean of the non-null values of a measure."""
    value = exact.mean(F.col(f"sum_{name}"), F.col(f"n_{name}"))
    return exact.stable(value) if name in _FLOATING else value
