"""Column names and types of the raw, conformed and fact tables."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
TIME = T.TimestampNTZType()
MONEY = T.DecimalType(10, 2)
MILES = T.DecimalType(8, 2)

# Services loaded by default; the high-volume one is mapped but must be asked for.
SERVICES = ["yellow", "green", "fhv"]
HIGH_VOLUME = "fhvhv"

# Name of a monthly source, as published.
SOURCE_NAME = "{service}_tripdata_{year}-{month:02d}"

# Source column -> table column, per service.
_METERED = {
    "VendorID": "vendor_id",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "RatecodeID": "ratecode_id",
    "store_and_fwd_flag": "store_and_fwd_flag",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
    "payment_type": "payment_type",
    "fare_amount": "fare_amount",
    "extra": "extra",
    "mta_tax": "mta_tax",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge",
    "total_amount": "total_amount",
    "congestion_surcharge": "congestion_surcharge",
}
COLUMN_MAP: dict[str, dict[str, str]] = {
    "yellow": {
        "tpep_pickup_datetime": "pickup_datetime",
        "tpep_dropoff_datetime": "dropoff_datetime",
        **_METERED,
        "Airport_fee": "airport_fee",
    },
    "green": {
        "lpep_pickup_datetime": "pickup_datetime",
        "lpep_dropoff_datetime": "dropoff_datetime",
        **_METERED,
        "ehail_fee": "ehail_fee",
        "trip_type": "trip_type",
    },
    "fhv": {
        "dispatching_base_num": "dispatching_base_num",
        "pickup_datetime": "pickup_datetime",
        "dropOff_datetime": "dropoff_datetime",
        "PUlocationID": "pu_location_id",
        "DOlocationID": "do_location_id",
        "SR_Flag": "sr_flag",
        "Affiliated_base_number": "affiliated_base_number",
    },
    "fhvhv": {
        "hvfhs_license_num": "hvfhs_license_num",
        "dispatching_base_num": "dispatching_base_num",
        "originating_base_num": "originating_base_num",
        "request_datetime": "request_datetime",
        "on_scene_datetime": "on_scene_datetime",
        "pickup_datetime": "pickup_datetime",
        "dropoff_datetime": "dropoff_datetime",
        "PULocationID": "pu_location_id",
        "DOLocationID": "do_location_id",
        "trip_miles": "trip_miles",
        "trip_time": "trip_time",
        "base_passenger_fare": "base_passenger_fare",
        "tolls": "tolls_amount",
        "bcf": "bcf",
        "sales_tax": "sales_tax",
        "congestion_surcharge": "congestion_surcharge",
        "airport_fee": "airport_fee",
        "tips": "tips",
        "driver_pay": "driver_pay",
        "shared_request_flag": "shared_request_flag",
        "shared_match_flag": "shared_match_flag",
        "access_a_ride_flag": "access_a_ride_flag",
        "wav_request_flag": "wav_request_flag",
        "wav_match_flag": "wav_match_flag",
    },
}

# Whole-number columns whose bad texts become NULL instead of rejecting the row.
TOLERANT_INTEGERS: dict[str, set[str]] = {
    "yellow": set(),
    "green": {
        "payment_type", "trip_type", "vendor_id", "ratecode_id", "pu_location_id",
        "do_location_id",
    },
    "fhv": {"pu_location_id", "do_location_id"},
    "fhvhv": {"pu_location_id", "do_location_id"},
}

# Conformed row-level table: one row per trip of any service.
CONFORMED = T.StructType(
    [
        T.StructField("trip_id", LONG),
        T.StructField("file_type", STRING, False),
        T.StructField("year", INT, False),
        T.StructField("month", INT, False),
        T.StructField("processed_at", TIME),
        T.StructField("pickup_datetime", TIME),
        T.StructField("dropoff_datetime", TIME),
        T.StructField("passenger_count", INT),
        T.StructField("trip_distance", MILES),
        T.StructField("payment_type", INT),
        T.StructField("fare_amount", MONEY),
        T.StructField("extra", MONEY),
        T.StructField("mta_tax", MONEY),
        T.StructField("tip_amount", MONEY),
        T.StructField("tolls_amount", MONEY),
        T.StructField("improvement_surcharge", MONEY),
        T.StructField("total_amount", MONEY),
        T.StructField("congestion_surcharge", MONEY),
        T.StructField("airport_fee", MONEY),
        T.StructField("ehail_fee", MONEY),
        T.StructField("trip_type", INT),
        T.StructField("vendor_id", INT),
        T.StructField("ratecode_id", INT),
        T.StructField("store_and_fwd_flag", STRING),
        T.StructField("pu_location_id", INT),
        T.StructField("do_location_id", INT),
        T.StructField("dispatching_base_num", STRING),
        T.StructField("affiliated_base_number", STRING),
        T.StructField("sr_flag", STRING),
    ]
)
LINEAGE = ["trip_id", "file_type", "year", "month", "processed_at"]
ONE_CHARACTER = ["store_and_fwd_flag", "sr_flag"]
PARTITIONS = ["file_type", "year", "month"]

# The wide canonical column list, in table order, with types.
CANONICAL: dict[str, T.DataType] = {
    "pickup_datetime": TIME,
    "dropoff_datetime": TIME,
    "passenger_count": DOUBLE,
    "trip_distance": DOUBLE,
    "payment_type": DOUBLE,
    "fare_amount": DOUBLE,
    "extra": DOUBLE,
    "mta_tax": DOUBLE,
    "tip_amount": DOUBLE,
    "tolls_amount": DOUBLE,
    "improvement_surcharge": DOUBLE,
    "total_amount": DOUBLE,
    "congestion_surcharge": DOUBLE,
    "airport_fee": DOUBLE,
    "ehail_fee": DOUBLE,
    "trip_type": DOUBLE,
    "vendor_id": DOUBLE,
    "ratecode_id": DOUBLE,
    "store_and_fwd_flag": STRING,
    "pu_location_id": DOUBLE,
    "do_location_id": DOUBLE,
    "hvfhs_license_num": STRING,
    "dispatching_base_num": STRING,
    "originating_base_num": STRING,
    "affiliated_base_number": STRING,
    "trip_miles": DOUBLE,
    "trip_time": INT,
    "base_passenger_fare": DOUBLE,
    "bcf": DOUBLE,
    "sales_tax": DOUBLE,
    "tips": DOUBLE,
    "driver_pay": DOUBLE,
    "shared_request_flag": STRING,
    "shared_match_flag": STRING,
    "access_a_ride_flag": STRING,
    "wav_request_flag": STRING,
    "wav_match_flag": STRING,
    "sr_flag": DOUBLE,
}
