"""Registered queries over aggregates that are stored, merged and kept up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.catalog import stored
from tripstar.catalog.analytics import Query
from tripstar.functions import temporal
from tripstar.operators import clustering, facts, ledger, ranking, rollups, skew
from tripstar.operators.bucketed import BucketedTable
from tripstar.plans import rollup_marts
from tripstar.plans.deltas import AGGREGATES, DeltaFacts
from tripstar.plans.load import Warehouse
from tripstar.session import scratch_dir, splits
from tripstar.sources import testdata
from tripstar.streaming import jobs

PERCENTS = [25, 50, 75, 95]
WEEKLY = ["file_type", "day_of_week", "hour"]
ROWS_A_PART = 2_000_000  # trips of a bucket or a staged file, some hundred megabytes
SENT_BATCHES = 4  # that trips come in before their facts are kept up
FILES_A_BATCH = 10  # at least


# ---------------------------------------------------------------------------
# Distinct counts and quantiles
# ---------------------------------------------------------------------------
def _from_sets(build: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf_dir: build(stored.star(spark, sf_dir), stored.daily_sets(spark, sf_dir))


def _from_daily(build: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf_dir: build(stored.star(spark, sf_dir), stored.daily(spark, sf_dir))


def monthly_actives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup_marts.monthly_actives(stored.daily_sets(spark, sf_dir))


def revenue_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue quantiles in cents per service, day of week and hour, from the counts of all days."""
    counts = rollup_marts.weekly_slots(stored.slot_revenue(spark, sf_dir))
    return rollups.quantiles(counts, WEEKLY, PERCENTS)


def service_revenue_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts merged further, to services, with the middle of each class as estimate."""
    found = rollups.quantiles(stored.slot_revenue(spark, sf_dir), ["file_type"], PERCENTS)
    middles = [rollups.middle(F.col(f"p{p}")).alias(f"p{p}_estimate") for p in PERCENTS]
    return found.select("*", *middles)


def revenue_quantile_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank error of the estimated quantiles against all trips, the largest of each service."""
    fact = stored.fact(spark, sf_dir)
    counts = rollup_marts.weekly_slots(stored.slot_revenue(spark, sf_dir))
    return rollup_marts.rank_errors(fact, rollups.quantiles(counts, WEEKLY, PERCENTS), PERCENTS)


# ---------------------------------------------------------------------------
# Facts kept by deltas, dedupe in state
# ---------------------------------------------------------------------------
def _changing_trips(spark: SparkSession, sf_dir: str) -> str:
    """All trips as they came over four batches: moved, sent again unchanged, out of order, deleted.

    Ids repeat in the test trips, so each row gets one of its own. What counts in the end are the
    test trips, less those paid in the third way.
    """

    def write(path: str) -> None:
        # the place in the stored files, which every scan of them gives alike
        part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("bigint")
        trips = stored.trips(spark, sf_dir).withColumn("trip_id", part * 2**40 + F.col("_metadata.row_index"))
        moved = F.col("ratecode_id") == 2
        before = {
            "pickup_datetime": F.col("pickup_datetime") - F.expr("INTERVAL 40 DAYS"),
            "total_amount": (F.col("total_amount") * 2).cast("decimal(10,2)"),
            "vendor_id": F.lit(None).cast("int"),
        }
        earlier = trips.filter(moved).withColumns(before)
        sent = {  # batch, number in the order of sending, rows
            0: (1, trips.withColumns({c: F.when(moved, value).otherwise(F.col(c)) for c, value in before.items()})),
            1: (3, trips.filter(moved)),
            2: (2, earlier.unionByName(trips.filter("vendor_id = 1"))),  # overtaken by batch 1 where moved
            3: (4, trips.filter("payment_type = 3")),
        }
        for batch, (number, rows) in sent.items():
            part = rows.withColumns({"sent": F.lit(number), "deleted": F.lit(batch == 3)})
            part.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return stored.stored_path(spark, sf_dir, "changing-trips", write)


def _kept_facts(spark: SparkSession, sf_dir: str) -> DeltaFacts:
    """Facts kept through the batches: both aggregates folded after two, the hourly one at the end as well."""
    batches = _changing_trips(spark, sf_dir)

    def write(path: str) -> None:
        kept = DeltaFacts(Warehouse(spark, f"{path}/house"))
        for batch in range(SENT_BATCHES):
            kept.apply(spark.read.parquet(f"{batches}/batch={batch}"), batch, "sent", "deleted")
            if batch == 1:
                for name in AGGREGATES:
                    kept.fold(name)
        kept.fold("hourly")
        spark.range(1).write.parquet(f"{path}/done")

    path = stored.stored_path(spark, sf_dir, "kept-facts", write, "done")
    return DeltaFacts(Warehouse(spark, f"{path}/house"))


def delta_upkeep_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily aggregate after trips were sent, moved, sent again late and deleted: base and deltas."""
    return _kept_facts(spark, sf_dir).aggregate("daily")


def delta_upkeep_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly aggregate of the same batches, folded into its base at the end."""
    return _kept_facts(spark, sf_dir).aggregate("hourly")


def stream_delta_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows that count after the batches were streamed in, without their ids."""
    path = _changing_trips(spark, sf_dir)
    schema = spark.read.parquet(f"{path}/batch=0").schema
    # larger tables are written as more files: as many batches as were sent, however many files these are
    files = len(spark.read.option("recursiveFileLookup", "true").parquet(path).inputFiles())
    a_batch = max(FILES_A_BATCH, splits(files, SENT_BATCHES))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", a_batch).option("recursiveFileLookup", "true").parquet(path)
    house = Warehouse(spark, scratch_dir(spark, "house"))
    kept = jobs.keep_up(house, stream, scratch_dir(spark, "checkpoint"), "sent", "deleted")
    return kept.fact().select("pickup_date_key", "pickup_time_key", "file_type", "vendor_id", "total_amount", "source_year", "source_month")


def stream_dedupe_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips kept once when some come again soon, some long after, and some come late for the first time."""
    trips = stored.trip_times(spark, sf_dir)
    path = scratch_dir(spark, "arrivals")
    late = F.pmod("trip_id", F.lit(7)) == 1
    again = F.pmod("trip_id", F.lit(3)) == 0
    year = F.year("pickup_datetime")
    years = [r[0] for r in trips.select(year.alias("y")).distinct().orderBy("y").collect()]
    house, checkpoint = Warehouse(spark, scratch_dir(spark, "house")), scratch_dir(spark, "checkpoint")
    for i, y in enumerate([*years, None]):
        if y is None:  # at last the late ones, and some of the first years once more
            rows = trips.filter(late).unionAll(trips.filter(again & (year <= years[len(years) // 2])))
        else:
            rows = trips.filter((year == y) & ~late)
            rows = rows.unionAll(rows.filter(again))
            if i:
                rows = rows.unionAll(trips.filter((year == years[i - 1]) & again & ~late))
        rows.write.parquet(f"{path}/step={i}")
        if i % 3 == 2 or y is None:  # the job is started again and goes on
            stream = spark.readStream.schema(trips.schema).option("recursiveFileLookup", "true").parquet(path)
            jobs.append_once(house, stream, "trips", ["trip_id", "pickup_datetime"], "pickup_datetime", checkpoint, "40 days")
    return house.read("trips").select("trip_id", temporal.date_key(F.col("pickup_datetime")).alias("pickup_date_key"), temporal.time_key(F.col("pickup_datetime")).alias("pickup_time_key"))


# ---------------------------------------------------------------------------
# Key layout, ranks, contents
# ---------------------------------------------------------------------------
def fact_trips_incremental_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows not loaded yet, found in a loaded table that is bucketed by trip and not shuffled."""
    fact = stored.fact(spark, sf_dir)
    buckets = max(16, splits(fact.count(), ROWS_A_PART))  # the count reads footers
    loaded = BucketedTable(spark, ["trip_id"], buckets).write(fact.filter("store_fwd_flag = 'Y'"))
    return loaded.missing(fact)


def merge_upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes merged into their bucketed table; routes without a pickup place have NULL as key."""
    existing, incoming = testdata.route_versions(spark, sf_dir)
    keys = ["file_type", "year", "month", "pu_location_id", "do_location_id"]
    table = BucketedTable(spark, keys, 16).write(existing)
    return table.merge(incoming, ["total_trips", "total_amount", "updated_at"]).read()


def trip_revenue_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trip with its rank by revenue among all trips of its service."""
    trips = stored.fact(spark, sf_dir).select("file_type", "pickup_date_key", "pickup_time_key", "total_amount")
    return ranking.ranked(trips, {"total_amount": "desc"}, ["file_type"]).drop("row_number")


def route_day_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense numbers of all routes and days that occur, in their order, and the busiest first."""
    keys = ["date_key", "pickup_location_id", "dropoff_location_id"]
    days = stored.daily(spark, sf_dir).groupBy(*keys).agg(F.sum("total_trips").alias("trips"))
    numbered = ranking.ranked(days, dict.fromkeys(keys, "asc")).select(*keys, "trips", F.col("row_number").alias("number"))
    return ranking.ranked(numbered, {"trips": "desc"}).drop("row_number")


def reconcile_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months whose stored trips are not the source's, though their counts are equal."""
    trips = stored.trips(spark, sf_dir).drop("processed_at")
    changed = (F.col("month") == 3) & (F.col("vendor_id") == 2)
    raised = F.when(changed, F.col("total_amount") + F.lit(0.01).cast("decimal(10,2)")).otherwise(F.col("total_amount"))
    loaded = trips.withColumn("total_amount", raised.cast("decimal(10,2)"))
    keys = ["file_type", "year", "month"]
    return ledger.reconcile_contents(trips, loaded, keys, [c for c in trips.columns if c not in keys])


CLUSTERED_PLACE, CLUSTERED_MONTH = 4, (1997, 6)


def clustered_place_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips and revenue of one place over all days, and of one month over all places, from files clustered on both."""

    def write(path: str) -> None:
        keys = {"day": F.col("pickup_date_key"), "place": F.col("pickup_location_id")}
        clustering.write_clustered(stored.fact(spark, sf_dir), path, keys, 32)

    fact = spark.read.parquet(stored.stored_path(spark, sf_dir, "fact-clustered", write))
    place = fact.filter(F.col("pickup_location_id") == CLUSTERED_PLACE)
    month = facts.in_month(fact, *CLUSTERED_MONTH)
    totals = [F.count(F.lit(1)).alias("trips"), F.sum("total_amount").cast("decimal(20,2)").alias("revenue")]
    return place.groupBy(F.lit("place").alias("filtered_by"), "file_type").agg(*totals).unionAll(
        month.groupBy(F.lit("month").alias("filtered_by"), "file_type").agg(*totals)
    )


def place_activity_supplied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips and revenue by zone of a location table of the caller's, its heavy places salted."""
    places = stored.star(spark, sf_dir).dim_location.select("location_id", "zone_name", "borough")
    trips = stored.fact(spark, sf_dir).select("pickup_location_id", "file_type", "total_amount")
    joined = skew.salted_join(trips, places, "pickup_location_id", "location_id", "left")
    return joined.groupBy("borough", "zone_name", "file_type").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("total_amount").cast("decimal(20,2)").alias("revenue")
    )


UPKEEP: dict[str, Query] = {
    "monthly_actives": monthly_actives,
    "service_activity": _from_sets(rollup_marts.service_activity),
    "route_activity": _from_daily(rollup_marts.route_activity),
    "vendor_activity": _from_daily(rollup_marts.vendor_activity),
    "revenue_quantiles": revenue_quantiles,
    "service_revenue_quantiles": service_revenue_quantiles,
    "revenue_quantile_error": revenue_quantile_error,
    "delta_upkeep_daily": delta_upkeep_daily,
    "delta_upkeep_hourly": delta_upkeep_hourly,
    "stream_delta_fact": stream_delta_fact,
    "stream_dedupe_state": stream_dedupe_state,
    "fact_trips_incremental_bucketed": fact_trips_incremental_bucketed,
    "merge_upsert_bucketed": merge_upsert_bucketed,
    "trip_revenue_ranks": trip_revenue_ranks,
    "route_day_numbers": route_day_numbers,
    "reconcile_contents": reconcile_contents,
    "clustered_place_month": clustered_place_month,
    "place_activity_supplied": place_activity_supplied,
}
