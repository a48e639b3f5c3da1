"""Checks of the declared keys, references and required columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstar.functions import temporal
from tripstar.star import Star

# Declared references, column -> dimension.
FACT_REFERENCES = {
    "pickup_date_key": "dim_date", "dropoff_date_key": "dim_date",
    "pickup_time_key": "dim_time", "dropoff_time_key": "dim_time",
    "pickup_location_id": "dim_location", "dropoff_location_id": "dim_location",
    "vendor_id": "dim_vendor", "payment_type_id": "dim_payment_type",
    "ratecode_id": "dim_rate_code", "trip_type_id": "dim_trip_type",
    "file_type": "dim_file_source", "store_fwd_flag": "dim_store_fwd_flag",
}
DAILY_REFERENCES = {
    "date_key": "dim_date", "pickup_location_id": "dim_location",
    "dropoff_location_id": "dim_location", "file_type": "dim_file_source",
    "vendor_id": "dim_vendor",
}
HOURLY_REFERENCES = {
    "date_key": "dim_date", "time_key": "dim_time", "file_type": "dim_file_source",
    "pickup_location_id": "dim_location",
}
# Columns declared NOT NULL.
FACT_REQUIRED = [
    "trip_id", "pickup_date_key", "pickup_time_key", "file_type", "source_year", "source_month",
]


def pk_duplicates(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Per table: keys that occur more than once, and the rows too many."""

    def one(name: str, rows: DataFrame, keys: list[str]) -> DataFrame:
        per_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        repeated = F.col("n") > 1
        return per_key.agg(
            F.count_if(repeated).alias("duplicate_keys"),
            F.coalesce(F.sum(F.when(repeated, F.col("n") - 1)), F.lit(0)).alias("extra_rows"),
        ).select(F.lit(name).alias("table_name"), "duplicate_keys", "extra_rows")

    return reduce(DataFrame.unionByName, [one(n, *t) for n, t in tables.items()])


def fk_orphans(star: Star, name: str, rows: DataFrame, references: dict[str, str]) -> DataFrame:
    """Per reference: rows whose key is not NULL and not in the dimension.

    All references of a table are tested in one pass over it, each against the bare
    keys of its dimension.
    """
    checked = rows.select(*references)
    for column, dim in references.items():
        checked = star.attach(checked, dim, column, {f"_{column}": F.lit(True)}, "left")
    orphans = {
        c: F.count_if(F.col(c).isNotNull() & F.col(f"_{c}").isNull()) for c in references
    }
    counts = checked.agg(*[count.alias(c) for c, count in orphans.items()])
    entries: list[Column] = [
        F.struct(
            F.lit(name).alias("table_name"), F.lit(c).alias("column_name"),
            F.lit(dim).alias("dimension"), F.col(c).alias("orphan_rows"),
        )
        for c, dim in references.items()
    ]
    return counts.select(F.inline(F.array(*entries)))


def not_null_violations(name: str, rows: DataFrame, required: list[str]) -> DataFrame:
    """Per required column: rows where it is NULL, in one pass."""
    counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    entries: list[Column] = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in required
    ]
    return counts.select(F.inline(F.array(*entries))).select(
        F.lit(name).alias("table_name"), "column_name", "null_rows"
    )


def stray_months(fact: DataFrame) -> DataFrame:
    """Pickup months that hold trips of another file month, and their size.

    These are the months whose aggregates a load of that file leaves stale.
    """
    picked_up = temporal.month_of_key(F.col("pickup_date_key"))
    filed = F.col("source_year") * 100 + F.col("source_month")
    return (
        fact.groupBy("file_type", picked_up.alias("pickup_month"))
        .agg(
            F.count_if(filed != picked_up).alias("stray_trips"),
            F.count(F.lit(1)).alias("month_trips"),
        )
        .filter(F.col("stray_trips") > 0)
    )
