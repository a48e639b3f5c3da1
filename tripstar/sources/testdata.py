"""Trip-shaped views of the order tables used for checking.

``lineitem`` becomes a conformed trip table with every edge case the operators
must handle (missing times, zero fares, unknown and orphan places, repeated
ids, trips outside their file's month). Return flags A, N and R stand for the
yellow, green and for-hire services.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.schemas import CONFORMED, PARTITIONS

PROCESSED_AT = "2025-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conformed trip table made from ``lineitem``."""
    return trips_from(table(spark, sf_dir, "lineitem"))


def trips_from(lineitem: DataFrame) -> DataFrame:
    c = F.col
    for_hire = c("l_returnflag") == "R"
    metered = ~for_hire
    price = c("l_extendedprice").cast("decimal(10,2)")
    seconds = (c("l_orderkey") * 37 + c("l_partkey") * 11) % 86400
    ride = (c("l_quantity") * 60).cast("bigint") + c("l_linenumber") * 7
    shipped = lambda s: _plus_seconds(c("l_shipdate"), s)
    filed = _filed()
    money = lambda e: e.cast("decimal(10,2)")
    whole = lambda e: e.cast("int")
    rate = lambda name: c(name).cast("decimal(4,2)")

    columns: dict[str, Column] = {
        "trip_id": c("l_orderkey") * 10 + c("l_linenumber"),
        "file_type": F.when(for_hire, "fhv").when(c("l_returnflag") == "N", "green")
        .otherwise("yellow"),
        "year": F.year(filed),
        "month": F.month(filed),
        "processed_at": F.lit(PROCESSED_AT).cast("timestamp_ntz"),
        "pickup_datetime": F.when(c("l_orderkey") % 211 != 0, shipped(seconds)),
        "dropoff_datetime": F.when(c("l_orderkey") % 97 != 0, shipped(seconds + ride)),
        "passenger_count": F.when(metered, whole(c("l_linenumber") % 6)),
        "trip_distance": F.when(
            metered,
            F.when(c("l_partkey") % 41 == 0, F.lit(0.0)).otherwise(c("l_quantity") / 2),
        ).cast("decimal(8,2)"),
        "payment_type": F.when(metered, whole(c("l_orderkey") % 7)),
        "fare_amount": F.when(
            metered, F.when(c("l_partkey") % 37 == 0, money(F.lit(0))).otherwise(price)
        ),
        "extra": F.when(metered, money(c("l_linenumber"))),
        "mta_tax": F.when(metered, money(F.lit("0.50"))),
        "tip_amount": F.when(metered, money(price * rate("l_discount"))),
        "tolls_amount": F.when(metered, money(price * rate("l_tax"))),
        "improvement_surcharge": F.when(metered, money(F.lit(1))),
        "total_amount": F.when(metered, price),
        "congestion_surcharge": F.when(metered, money(F.lit("2.50"))),
        "airport_fee": F.when(c("l_returnflag") == "A", money(F.lit("1.25"))),
        "ehail_fee": F.when(c("l_returnflag") == "N", money(F.lit(0))),
        "trip_type": F.when(c("l_returnflag") == "N", whole(c("l_orderkey") % 2 + 1)),
        "vendor_id": F.when(metered, whole(c("l_linenumber") % 4)),
        "ratecode_id": F.when(metered, whole(c("l_partkey") % 6 + 1)),
        "store_and_fwd_flag": F.when(
            metered, F.when(c("l_linestatus") == "F", "Y").otherwise("N")
        ),
        "pu_location_id": F.when(c("l_partkey") % 50 != 0, whole(c("l_suppkey") % 8)),
        "do_location_id": whole(c("l_partkey") % 8),
        "dispatching_base_num": F.when(for_hire, _base("l_suppkey")),
        "affiliated_base_number": F.when(for_hire, _base("l_partkey")),
        "sr_flag": F.when(for_hire & (c("l_linenumber") == 1), "1"),
    }
    return lineitem.select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in CONFORMED.fields]
    )


def raw(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    """Raw rows of one service: source column names, times and ids as text.

    Missing pickups read ``garbage``, missing places ``NaN``, missing drop-offs are
    empty, and one payment type in 89 orders is no number. ``year`` and ``month``
    are added as in a scan.
    """
    return raw_from(table(spark, sf_dir, "lineitem"), service)


def raw_from(lineitem: DataFrame, service: str) -> DataFrame:
    """The rows of :func:`raw`, from lines of ``lineitem``."""
    trip = trips_from(lineitem)
    text = lambda name: F.col(name).cast("string")
    stamp = lambda name: F.date_format(name, "yyyy-MM-dd HH:mm:ss")
    double = lambda name: F.col(name).cast("double")
    pickup = F.coalesce(stamp("pickup_datetime"), F.lit("garbage"))
    dropoff = F.coalesce(stamp("dropoff_datetime"), F.lit(""))
    place = lambda name: F.coalesce(text(name), F.lit("NaN"))
    order = F.floor(F.col("trip_id") / 10)

    metered = {
        "VendorID": text("vendor_id"),
        "passenger_count": F.col("passenger_count"),
        "trip_distance": double("trip_distance"),
        "RatecodeID": F.concat(text("ratecode_id"), F.lit(".0")),
        "store_and_fwd_flag": F.col("store_and_fwd_flag"),
        "PULocationID": place("pu_location_id"),
        "DOLocationID": place("do_location_id"),
        "payment_type": F.when(order % 89 == 0, "n/a").otherwise(text("payment_type")),
        **{
            name: double(name)
            for name in (
                "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
                "improvement_surcharge", "total_amount", "congestion_surcharge",
            )
        },
    }
    by_service = {
        "yellow": {
            "tpep_pickup_datetime": pickup,
            "tpep_dropoff_datetime": dropoff,
            **metered,
            "Airport_fee": double("airport_fee"),
        },
        "green": {
            "lpep_pickup_datetime": pickup,
            "lpep_dropoff_datetime": dropoff,
            **metered,
            "ehail_fee": double("ehail_fee"),
            "trip_type": text("trip_type"),
        },
        "fhv": {
            "dispatching_base_num": F.col("dispatching_base_num"),
            "pickup_datetime": pickup,
            "dropOff_datetime": dropoff,
            "PUlocationID": place("pu_location_id"),
            "DOlocationID": place("do_location_id"),
            "SR_Flag": F.col("sr_flag"),
            "Affiliated_base_number": F.col("affiliated_base_number"),
        },
    }
    own = trip.filter(F.col("file_type") == service)
    return own.select(*[c.alias(n) for n, c in by_service[service].items()], "year", "month")


def raw_high_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows of the high-volume service, from the for-hire lines of ``lineitem``."""
    c = F.col
    lineitem = table(spark, sf_dir, "lineitem").filter(c("l_returnflag") == "R")
    seconds = (c("l_orderkey") * 37 + c("l_partkey") * 11) % 86400
    ride = (c("l_quantity") * 60).cast("bigint") + c("l_linenumber") * 7
    stamp = lambda s: F.date_format(
        _plus_seconds(c("l_shipdate"), s), "yyyy-MM-dd HH:mm:ss"
    )
    flag = lambda test: F.when(test, "Y").otherwise("N")
    return lineitem.select(
        F.lit("HV0003").alias("hvfhs_license_num"),
        _base("l_suppkey").alias("dispatching_base_num"),
        _base("l_partkey").alias("originating_base_num"),
        stamp(seconds - 300).alias("request_datetime"),
        stamp(seconds - 60).alias("on_scene_datetime"),
        F.coalesce(F.when(c("l_orderkey") % 211 != 0, stamp(seconds)), F.lit("garbage"))
        .alias("pickup_datetime"),
        stamp(seconds + ride).alias("dropoff_datetime"),
        (c("l_suppkey") % 8).alias("PULocationID"),
        (c("l_partkey") % 8).alias("DOLocationID"),
        (c("l_quantity") / 2).alias("trip_miles"),
        ride.alias("trip_time"),
        c("l_extendedprice").alias("base_passenger_fare"),
        c("l_tax").alias("tolls"),
        F.when(c("l_partkey") % 50 == 0, F.lit(float("nan"))).otherwise(c("l_discount"))
        .alias("bcf"),
        c("l_tax").alias("sales_tax"),
        F.lit(2.75).alias("congestion_surcharge"),
        F.lit(2.5).alias("airport_fee"),
        c("l_discount").alias("tips"),
        c("l_extendedprice").alias("driver_pay"),
        flag(c("l_linenumber") == 1).alias("shared_request_flag"),
        flag(c("l_linenumber") == 2).alias("shared_match_flag"),
        F.lit(" ").alias("access_a_ride_flag"),
        flag(c("l_linestatus") == "F").alias("wav_request_flag"),
        flag(c("l_linestatus") == "O").alias("wav_match_flag"),
    )


def landing_rows(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    """Raw rows of one service with the name of their monthly source, rows of a month together.

    The lines are shuffled before their values become texts, which are longer.
    """
    placed = table(spark, sf_dir, "lineitem").withColumn("_filed", F.trunc(_filed(), "month")).hint("rebalance", "_filed")
    source = F.format_string("%s_tripdata_%04d-%02d.parquet", F.lit(service), "year", "month")
    return raw_from(placed, service).withColumn("source", source).drop("year", "month")


def write_landing(spark: SparkSession, sf_dir: str, landing: str) -> None:
    """Write the raw rows as monthly sources, one folder per service and month."""
    for service in ("yellow", "green", "fhv"):
        landing_rows(spark, sf_dir, service).write.mode("append").partitionBy("source").parquet(landing)


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An append-only log of fact build steps, made from ``orders``."""
    c = F.col
    step = c("o_custkey") % 3
    return table(spark, sf_dir, "orders").select(
        c("o_orderkey").alias("id"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.when(step == 0, "fact_trips").when(step == 1, "fact_trips_daily_agg")
        .otherwise("fact_trips_hourly_agg").alias("fact_table_name"),
        F.when(c("o_orderstatus") == "O", "loaded").when(c("o_orderstatus") == "F", "failed")
        .otherwise("started").alias("status"),
        c("o_custkey").alias("record_count"),
        _plus_seconds(c("o_orderdate"), c("o_orderkey") % 86400).alias("started_at"),
    )


def file_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of file status changes, made from ``orders``."""
    c = F.col
    service = c("o_custkey") % 3
    return table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.when(service == 0, "yellow").when(service == 1, "green").otherwise("fhv")
        .alias("file_type"),
        F.when(c("o_orderstatus") == "O", "UPLOADED")
        .when(c("o_orderstatus") == "F", "AVAILABLE").otherwise("MISSING").alias("status"),
        c("o_orderkey").alias("seq"),
    )


def route_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """An existing route table and new rows for it: lines of status F and of status O.

    Trips without a pickup place are routes as well: NULL is one of the keys.
    """
    lineitem = table(spark, sf_dir, "lineitem")

    def summary(status: str, stamp: str) -> DataFrame:
        rows = trips_from(lineitem.filter(F.col("l_linestatus") == status))
        return rows.groupBy(*PARTITIONS, "pu_location_id", "do_location_id").agg(
            F.count(F.lit(1)).alias("total_trips"),
            F.sum("total_amount").alias("total_amount"),
            F.lit(stamp).alias("created_at"),
            F.lit(stamp).alias("updated_at"),
        )

    return summary("F", "first"), summary("O", "second")


def _filed() -> Column:
    """The day whose month's file holds a line."""
    return F.date_sub(F.col("l_shipdate").cast("date"), 1)


def _plus_seconds(ts: Column, seconds: Column) -> Column:
    return ts + F.expr("interval 1 second") * seconds


def _base(column: str) -> Column:
    return F.concat(F.lit("B"), F.lpad(F.col(column).cast("string"), 5, "0"))

