"""Registered operations: sources, normalisation, loads, merges, logs, audits, streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.catalog import stored
from tripstar.catalog.analytics import Query
from tripstar.functions import temporal
from tripstar.operators import audits, facts, ledger, normalize, summaries, upsert
from tripstar.plans import load as loads
from tripstar.schemas import PARTITIONS, SERVICES
from tripstar.session import scratch_dir, splits
from tripstar.sources import raw_files, testdata
from tripstar.streaming import jobs

ROWS_A_FILE = 2_000_000  # trips of a staged file, some hundred megabytes


def _house(spark: SparkSession) -> loads.Warehouse:
    return loads.Warehouse(spark, scratch_dir(spark, "house"))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# ---------------------------------------------------------------------------
# Sources and normalisation
# ---------------------------------------------------------------------------
def scan_service_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every service-month scanned by name: rows, and rows without a pickup place."""
    path = stored.landing(spark, sf_dir)
    places = {"yellow": "PULocationID", "green": "PULocationID", "fhv": "PUlocationID"}
    return _union(
        [
            raw_files.read_raw(spark, path, service)
            .groupBy(F.lit(service).alias("file_type"), "year", "month")
            .agg(
                F.count(F.lit(1)).alias("rows_in_file"),
                F.count_if(F.col(place) == "NaN").alias("without_place"),
            )
            for service, place in places.items()
        ]
    )


def case_insensitive_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metered rows whose columns come in odd case and lack the service's own fee."""

    def odd(service: str, fee: str) -> DataFrame:
        rows = stored.raw(spark, sf_dir, service).drop(fee)
        return rows.toDF(*[c.swapcase() for c in rows.columns])

    def shared(service: str, fee: str) -> DataFrame:
        rows = raw_files.match_columns(odd(service, fee), service)
        return rows.select(
            F.lit(service).alias("file_type"), "VendorID", "PULocationID", "DOLocationID",
            "payment_type", "total_amount", F.col(fee).cast("double").alias("fee"),
        )

    return shared("yellow", "Airport_fee").unionByName(shared("green", "ehail_fee"))


def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows kept and rows set aside per service and month, with the bad columns."""

    def counted(service: str) -> DataFrame:
        good, bad = normalize.split_rejects(stored.raw(spark, sf_dir, service), service)
        both = good.select("year", "month", F.lit("").alias("bad_columns")).unionByName(
            bad.select("year", "month", "bad_columns")
        )
        return both.groupBy(
            F.lit(service).alias("file_type"), "year", "month", "bad_columns"
        ).agg(F.count(F.lit(1)).alias("n"))

    return _union([counted(service) for service in SERVICES])


def null_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts and floats that mean "missing", in every service, made NULL."""
    columns = {
        "yellow": ("PULocationID", "tpep_dropoff_datetime", "total_amount"),
        "green": ("PULocationID", "lpep_dropoff_datetime", "total_amount"),
        "fhv": ("PUlocationID", "dropOff_datetime", None),
        "fhvhv": ("PULocationID", "dropoff_datetime", "bcf"),
    }

    def cleaned(service: str) -> DataFrame:
        rows = stored.raw(spark, sf_dir, service)
        place, time, amount = columns[service]
        picked = rows.select(
            F.lit(service).alias("file_type"),
            F.col(place).cast("string").alias("place"),
            F.col(time).alias("dropoff"),
            (F.col(amount) if amount else F.lit(None)).cast("double").alias("amount"),
        )
        return normalize.null_sentinels(picked)

    return _union([cleaned(service) for service in columns])


def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Service-months with files in the landing folder."""
    files = raw_files.file_inventory(spark, stored.landing(spark, sf_dir))
    return files.select(*PARTITIONS, "in_scope").distinct()


def _conformed(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    good, _ = normalize.split_rejects(stored.raw(spark, sf_dir, service), service)
    return normalize.conform(good, service, strict=False).drop("trip_id", "processed_at")


def _normalized(service: str) -> Query:
    return lambda spark, sf_dir: _conformed(spark, sf_dir, service)


def normalize_fhvhv(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalize.align(stored.raw(spark, sf_dir, "fhvhv"), "fhvhv")
    return normalize.canonical(rows)


def align_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All services in the canonical columns, united."""
    return _union(
        [
            normalize.canonical(normalize.align(stored.raw(spark, sf_dir, s), s))
            for s in SERVICES
        ]
    )


def trip_data_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.union_services([_conformed(spark, sf_dir, s) for s in SERVICES])


def parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = ["pickup_datetime", "dropoff_datetime"]
    parts = []
    for service in SERVICES:
        rows = normalize.align(stored.raw(spark, sf_dir, service), service)
        parsed = normalize.parse_timestamps(rows, times)
        parts.append(parsed.select(F.lit(service).alias("file_type"), *times))
    return _union(parts)


def correct_numeric_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = ["fare_amount", "trip_distance", "passenger_count", "payment_type"]
    parts = []
    for service in SERVICES:
        rows = normalize.align(stored.raw(spark, sf_dir, service), service)
        typed = normalize.correct_numeric_types(rows, numbers)
        parts.append(typed.select(F.lit(service).alias("file_type"), *numbers))
    return _union(parts)


def filter_invalid_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.filter_invalid_trips(stored.trips(spark, sf_dir)).select(
        "trip_id", "file_type", "fare_amount", "trip_distance", "passenger_count"
    )


def target_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each order date as the date of a run, the month that run loads."""
    target = temporal.target_month(F.col("o_orderdate"))
    return testdata.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year(target).alias("target_year"), F.month(target).alias("target_month")
    )


# ---------------------------------------------------------------------------
# Loads
# ---------------------------------------------------------------------------
def load_month_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trip table after loading every month twice."""
    house, path = _house(spark), stored.landing(spark, sf_dir)
    for _ in range(2):
        loads.load_services(house, path, force=True)
    return _loaded_summary(house)


def _loaded_summary(house: loads.Warehouse) -> DataFrame:
    return house.read("trip_data").groupBy(*PARTITIONS).agg(
        F.count(F.lit(1)).alias("trips"),
        F.countDistinct("trip_id").alias("ids"),
        F.sum("total_amount").alias("total_amount"),
        F.count("payment_type").alias("with_payment"),
    )


def load_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome per service when one of them has no sources, with the rows loaded."""
    house = _house(spark)
    outcomes = loads.load_services(house, stored.landing(spark, sf_dir), [*SERVICES, "fhvhv"])
    rows = house.load_log().latest().groupBy("file_type").agg(
        F.sum("rows_in_file").alias("rows_in_file"), F.sum("rows_loaded").alias("rows_loaded")
    )
    return outcomes.join(rows, "file_type", "left").drop("error")


def _landing_with(spark: SparkSession, sf_dir: str, change, services: list[str] = SERVICES) -> str:
    """Monthly sources whose raw rows are changed per service before they are written."""
    path = scratch_dir(spark, "landing")
    for service in services:
        rows = change(service, stored.raw(spark, sf_dir, service))
        for part in rows if isinstance(rows, list) else [rows]:
            source = F.format_string("%s_tripdata_%04d-%02d.parquet", F.lit(service), "year", "month")
            part.withColumn("source", source).drop("year", "month").hint("rebalance", "source").write.mode(
                "append"
            ).partitionBy("source").parquet(path)
    return path


def load_mixed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months loaded together of which only the even ones have the airport fee."""

    def change(_: str, rows: DataFrame) -> list[DataFrame]:
        even = F.col("month") % 2 == 0
        return [rows.filter(even), rows.filter(~even).drop("Airport_fee")]

    house = _house(spark)
    loads.load_services(house, _landing_with(spark, sf_dir, change, ["yellow"]), ["yellow"])
    return house.read("trip_data").groupBy(*PARTITIONS).agg(
        F.count(F.lit(1)).alias("trips"), F.count("airport_fee").alias("with_fee")
    )


def load_corrected_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips and rejects after yellow files whose rows were all bad came again, corrected."""

    def broken(_: str, rows: DataFrame) -> DataFrame:
        return rows.withColumn("payment_type", F.lit("bad"))

    house = _house(spark)
    loads.load_services(house, _landing_with(spark, sf_dir, broken, ["yellow"]), ["yellow"])
    loads.load_services(house, stored.landing(spark, sf_dir), ["yellow"], force=True)
    logged = house.load_log().latest().filter(F.col("status") == "loaded").select(*PARTITIONS, "rows_loaded")
    count = lambda table, name: house.read(table).groupBy(*PARTITIONS).agg(
        F.count(F.lit(1)).alias(name)
    )
    return (
        logged.join(count("trip_data", "trips"), PARTITIONS, "left")
        .join(count("trip_rejects", "rejects"), PARTITIONS, "left")
        .fillna(0, ["trips", "rejects"])
    )


def load_past_bad_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months logged as loaded and as failed, when one month holds a file that is no Parquet."""
    path = _landing_with(spark, sf_dir, lambda _, rows: rows, ["green"])
    broken = f"{path}/source=green_tripdata_2099-01.parquet"
    spark.range(1).select(F.lit("no parquet").alias("value")).coalesce(1).write.text(broken)
    house = _house(spark)
    outcomes = loads.load_services(house, path, ["green"]).select("file_type", F.col("status").alias("outcome"))
    entries = house.load_log().latest().groupBy("file_type").agg(
        F.count_if(F.col("status") == "loaded").alias("loaded"),
        F.count_if(F.col("status") == "error").alias("failed"),
        F.sum("rows_loaded").alias("rows_loaded"),
    )
    return outcomes.join(entries, "file_type")


def load_late_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips, ids, and ids kept per month after every month got a late file.

    The first files hold the rows of vendor 1; a late one holds the others.
    """
    first = F.col("VendorID") == "1"
    services = ["green"]
    path = _landing_with(spark, sf_dir, lambda _, rows: rows.filter(first), services)
    house = _house(spark)
    loads.load_services(house, path, services)
    before = house.read("trip_data").select("trip_id", "vendor_id", *PARTITIONS)
    kept = scratch_dir(spark, "ids")
    before.write.parquet(kept)
    for service in services:
        rows = stored.raw(spark, sf_dir, service).filter(~F.coalesce(first, F.lit(False)))
        source = F.format_string("%s_tripdata_%04d-%02d.parquet", F.lit(service), "year", "month")
        rows.withColumn("source", source).drop("year", "month").write.mode("append").partitionBy(
            "source"
        ).parquet(path)
    loads.load_services(house, path, services, force=True)
    old = spark.read.parquet(kept).withColumn("old", F.lit(True))
    after = house.read("trip_data").join(old, ["trip_id", "vendor_id", *PARTITIONS], "left")
    return after.groupBy(*PARTITIONS).agg(
        F.count(F.lit(1)).alias("trips"),
        F.countDistinct("trip_id").alias("ids"),
        F.count("old").alias("ids_kept"),
    )


def build_facts_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily aggregate after months were loaded in two lots, each followed by a build."""
    house, trips = _house(spark), stored.trips(spark, sf_dir)
    for lot in (F.col("month") % 2 == 0, F.col("month") % 2 == 1):
        house.overwrite("trip_data", trips.filter(lot), PARTITIONS)
        loads.build_facts(house)
    return house.read("fact_trips_daily_agg").drop("year", "month")


def summary_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trip summary after months were merged in two lots that overlap."""
    house, trips = _house(spark), stored.trips(spark, sf_dir)
    for lot in (F.col("month") <= 7, F.col("month") >= 6):
        loads.update_summaries(house, trips.filter(lot))
    return house.read("fact_trip_summary").select(*summaries.trip_summary(trips).columns)


def file_status_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose status moves on: months up to June are published, loaded months stored."""
    current = ledger.file_status_latest(testdata.file_events(spark, sf_dir))
    published = current.filter(F.col("month") <= 6)
    return ledger.next_statuses(current, published, stored.trips(spark, sf_dir))


def build_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of a fact build over the whole trip table, with the rows each wrote."""
    house = _house(spark)
    house.overwrite("trip_data", stored.trips(spark, sf_dir), PARTITIONS)
    return loads.build_facts(house).select("fact_table_name", "status", "record_count")


def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in the sources against rows conformed, per service and month."""
    raw = _union(
        [
            stored.raw(spark, sf_dir, s).select(F.lit(s).alias("file_type"), "year", "month")
            for s in SERVICES
        ]
    )
    return ledger.reconcile(raw, trip_data_union(spark, sf_dir), PARTITIONS)


# ---------------------------------------------------------------------------
# Merges, logs, audits
# ---------------------------------------------------------------------------
_ROUTE = [*PARTITIONS, "pu_location_id", "do_location_id"]
_REPLACED = ["total_trips", "total_amount", "updated_at"]


def merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.insert_only(*testdata.route_versions(spark, sf_dir), _ROUTE)


def merge_update_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.update_only(*testdata.route_versions(spark, sf_dir), _ROUTE, _REPLACED)


def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current version of a table after a merge into its first version."""
    existing, incoming = testdata.route_versions(spark, sf_dir)
    versions = upsert.VersionedTable(spark, scratch_dir(spark, "routes"))
    versions.replace(existing)
    versions.merge(incoming, _ROUTE, _REPLACED)
    return versions.read()


def log_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["year", "month", "fact_table_name"]
    return ledger.latest(testdata.run_log(spark, sf_dir), keys, ["started_at", "id"])


def steps_to_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.steps_to_run(testdata.run_log(spark, sf_dir), ["started_at", "id"])


def file_status_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.file_status_latest(testdata.file_events(spark, sf_dir))


def month_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.month_completeness(file_status_latest(spark, sf_dir))


def audit_pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate keys of stored tables; some rows of the aggregates were appended twice."""
    fact = stored.fact(spark, sf_dir)
    daily, hourly = stored.with_repeats(spark, sf_dir)
    log = testdata.file_events(spark, sf_dir)
    return audits.pk_duplicates(
        {
            "fact_trips": (fact, ["trip_id"]),
            "fact_trips_daily_agg": (daily, facts.DAILY_KEYS),
            "fact_trips_hourly_agg": (hourly, facts.HOURLY_KEYS),
            "file_events": (log, PARTITIONS),
        }
    )


def audit_fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = stored.star(spark, sf_dir)
    fact = tables.fact_trips
    return _union(
        [
            audits.fk_orphans(tables, "fact_trips", fact, audits.FACT_REFERENCES),
            audits.fk_orphans(
                tables, "fact_trips_daily_agg", facts.daily_agg(fact), audits.DAILY_REFERENCES
            ),
            audits.fk_orphans(
                tables, "fact_trips_hourly_agg", facts.hourly_agg(fact), audits.HOURLY_REFERENCES
            ),
        ]
    )


def audit_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required columns of the fact, and of the conformed trips before the pickup filter."""
    trips = stored.trips(spark, sf_dir)
    return audits.not_null_violations(
        "fact_trips", facts.fact_trips(trips), audits.FACT_REQUIRED
    ).unionByName(
        audits.not_null_violations(
            "trip_data", trips, ["file_type", "year", "month", "pickup_datetime"]
        )
    )


def audit_stray_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.stray_months(stored.fact(spark, sf_dir))


# ---------------------------------------------------------------------------
# Streams
# ---------------------------------------------------------------------------
def stream_ingest_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    house = _house(spark)
    jobs.ingest(house, stored.landing(spark, sf_dir), scratch_dir(spark, "checkpoint"))
    return _loaded_summary(house)


def stream_hourly_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = testdata.table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(
        sf_dir
    )
    cents = F.rint(F.col("value") * 100).cast("bigint")
    demand = jobs.hourly_demand(events.withColumn("cents", cents), "ts", "event_type", "cents")
    house = _house(spark)
    jobs.keep_hours(house, demand, "demand", scratch_dir(spark, "checkpoint"))
    return jobs.hours_so_far(house, "demand")


def _staged(spark: SparkSession, rows: DataFrame, by: list[str], files: int) -> DataFrame:
    """Rows written as files that a stream then takes in a few batches.

    ``files`` is the number of batches; more rows make more files in each.
    """
    path = scratch_dir(spark, "staged")
    a_batch = splits(rows.count(), files * ROWS_A_FILE)
    rows.repartitionByRange(files * a_batch, *by).write.parquet(path)
    return (
        spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", a_batch).parquet(path)
    )


def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip ids kept when trips arrive in several batches and ids repeat across them."""
    trips = stored.trips(spark, sf_dir).filter(F.col("pickup_datetime").isNotNull())
    stream = _staged(spark, trips.select("trip_id", "pickup_datetime"), ["pickup_datetime"], 3)
    house = _house(spark)
    jobs.append_new(house, stream, "trips", "trip_id", scratch_dir(spark, "checkpoint"))
    return house.read("trips").select("trip_id")


def stream_late_recompute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily aggregate after trips arrived by file month, strays included.

    A third of the file months is built in a batch, then all trips are streamed in, those
    of the batch once more. Ids repeat in the test trips, so each gets one of its own.
    """
    path = scratch_dir(spark, "trips")
    stored.trips(spark, sf_dir).withColumn("trip_id", F.monotonically_increasing_id()).write.parquet(path)
    trips = spark.read.parquet(path)
    house = _house(spark)
    house.overwrite("trip_data", trips.filter(F.col("month") % 3 == 0), PARTITIONS)
    loads.build_facts(house)
    stream = _staged(spark, trips, ["year", "month"], 3)
    jobs.append_and_recompute(house, stream, scratch_dir(spark, "checkpoint"))
    return house.read("fact_trips_daily_agg").drop("year", "month")


OPERATIONS: dict[str, Query] = {
    "scan_service_month": scan_service_month,
    "case_insensitive_match": case_insensitive_match,
    "load_rejects": load_rejects,
    "null_sentinels": null_sentinels,
    "file_inventory": file_inventory,
    "normalize_yellow": _normalized("yellow"),
    "normalize_green": _normalized("green"),
    "normalize_fhv": _normalized("fhv"),
    "normalize_fhvhv": normalize_fhvhv,
    "align_schema": align_schema,
    "trip_data_union": trip_data_union,
    "parse_timestamps": parse_timestamps,
    "correct_numeric_types": correct_numeric_types,
    "filter_invalid_trips": filter_invalid_trips,
    "target_month": target_month,
    "load_month_idempotent": load_month_idempotent,
    "load_outcomes": load_outcomes,
    "load_mixed_columns": load_mixed_columns,
    "load_corrected_month": load_corrected_month,
    "load_past_bad_file": load_past_bad_file,
    "load_late_file": load_late_file,
    "build_facts": build_facts,
    "build_facts_incremental": build_facts_incremental,
    "summary_upsert": summary_upsert,
    "file_status_next": file_status_next,
    "reconcile_counts": reconcile_counts,
    "merge_insert_only": merge_insert_only,
    "merge_update_only": merge_update_only,
    "merge_upsert": merge_upsert,
    "log_latest": log_latest,
    "steps_to_run": steps_to_run,
    "file_status_latest": file_status_latest,
    "month_completeness": month_completeness,
    "audit_pk_duplicates": audit_pk_duplicates,
    "audit_fk_orphans": audit_fk_orphans,
    "audit_not_null": audit_not_null,
    "audit_stray_months": audit_stray_months,
    "stream_ingest_available_now": stream_ingest_available_now,
    "stream_hourly_demand": stream_hourly_demand,
    "stream_dedupe": stream_dedupe,
    "stream_late_recompute": stream_late_recompute,
}
