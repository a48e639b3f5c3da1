"""Incremental ingest, hourly demand, keyed dedupe, and recompute after late trips.

Every job runs over what has arrived and stops (``availableNow``). A batch that is
retried overwrites what it wrote before, so each input is counted once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripstar.operators import facts
from tripstar.plans.deltas import DeltaFacts
from tripstar.plans.load import (
    FACT_PARTITIONS,
    Warehouse,
    in_any_month,
    load,
    note_touched,
    rebuild_aggregates,
    touched_by,
)
from tripstar.schemas import SERVICES
from tripstar.session import scratch_dir
from tripstar.sources.raw_files import source_glob

_SOURCE = r"_tripdata_(\d{4})-(\d{2})"
_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def _run(stream: DataFrame, handle, checkpoint: str) -> StreamingQuery:
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def _months(rows: DataFrame, year: str, month: str) -> list[tuple[int, int]]:
    """Distinct months in a batch; their number is bounded by the calendar."""
    return sorted((r[0], r[1]) for r in rows.select(year, month).distinct().collect())


def ingest(
    house: Warehouse, landing: str, checkpoint: str, services: list[str] = SERVICES
) -> None:
    """Load the months of files that are new since the last run.

    The checkpoint remembers the files seen, in place of the load log. The stream
    carries one row per file and reads no content. A month that gets a further file
    is loaded again as a whole, which replaces its partition.
    """
    for service in services:
        part = lambda i: F.regexp_extract("path", _SOURCE, i).cast("int")
        files = (
            house.spark.readStream.format("binaryFile")
            .schema(_FILE)
            .option("pathGlobFilter", "*.parquet")
            .load(f"{landing}/{source_glob(service)}")
            .select(part(1).alias("year"), part(2).alias("month"))
        )

        def load_batch(batch: DataFrame, _: int, service: str = service) -> None:
            months = _months(batch, "year", "month")
            if months:
                load(house, landing, service, months, force=True)

        _run(files, load_batch, f"{checkpoint}/{service}")


def hourly_demand(
    events: DataFrame, time: str, service: str, value: str, delay: str = "1 hour"
) -> DataFrame:
    """Events and value per hour and service; an hour is final once ``delay`` has passed."""
    timed = events.withColumn("_time", F.col(time).cast("timestamp"))
    return (
        timed.withWatermark("_time", delay)
        .groupBy(F.window("_time", "1 hour"), F.col(service).alias("service"))
        .agg(F.count(F.lit(1)).alias("trips"), F.sum(value).alias("total_value"))
        .select(
            F.col("window.start").cast("timestamp_ntz").alias("hour_start"), "service", "trips",
            "total_value",
        )
    )


def append_final_hours(demand: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append hours to a table as they become final."""
    query = (
        demand.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def keep_hours(house: Warehouse, demand: DataFrame, table: str, checkpoint: str) -> None:
    """Keep every hour's last state, those still open included.

    Each batch writes the hours it changed; see :func:`hours_so_far`.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        house.overwrite(table, rows, ["batch_id"], clustered=True)

    query = (
        demand.writeStream.foreachBatch(write_batch)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def hours_so_far(house: Warehouse, table: str) -> DataFrame:
    """The last state of each hour and service; open hours are provisional."""
    last = F.max_by(F.struct("trips", "total_value"), "batch_id").alias("last")
    states = house.read(table).groupBy("hour_start", "service").agg(last)
    return states.select("hour_start", "service", "last.trips", "last.total_value")


def append_new(
    house: Warehouse, stream: DataFrame, table: str, key: str, checkpoint: str,
    within: tuple[str, str] | None = None,
) -> None:
    """Append the rows whose key the table does not hold yet, one row per key.

    Each batch writes its own partition and is compared with earlier batches only, so a
    retried batch gives the same rows. ``within`` names a year and a month column that a
    key never leaves: then only the months of the batch are compared.
    """
    by = [*(within or ()), "batch_id"]

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        new = batch.dropDuplicates([key])
        if house.has(table):
            earlier = house.read(table).filter(F.col("batch_id") < batch_id)
            if within:
                earlier = earlier.filter(in_any_month(_months(batch, *within), *within))
            new = facts.not_yet_loaded(new, earlier, key)
        new.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(*by).parquet(house.path(table))

    _run(stream, write_batch, checkpoint)


def append_and_recompute(house: Warehouse, trips: DataFrame, checkpoint: str) -> None:
    """Put arriving trips into the fact and rebuild the aggregates of their pickup months.

    The fact keeps its layout, so a house built in batches can be streamed into. A trip
    that is sent again replaces the one the partition holds; of several in one batch one
    is kept. A late trip changes the month it was picked up in, not the month of its
    file, and a trip sent again with another pickup changes both its months; only the partitions and months that a batch touches are read and replaced. A trip
    without an id could not be told from one that is sent again, so it fails the batch.
    """
    no_id = F.raise_error(F.lit("a trip has no trip_id"))

    def apply(batch: DataFrame, _: int) -> None:
        arrived = facts.fact_trips(batch)
        arrived = arrived.withColumn("trip_id", F.coalesce("trip_id", no_id))
        order = Window.partitionBy("trip_id").orderBy(F.desc("pickup_date_key"), F.xxhash64(*arrived.columns))
        rows = arrived.withColumn("_place", F.row_number().over(order)).filter("_place = 1").drop("_place")
        sources = _months(rows, "source_year", "source_month")
        if not sources:
            return
        note_touched(house, sources)
        touched = in_any_month(sources, "source_year", "source_month")
        if house.has("fact_trips"):
            held = house.read("fact_trips").filter(touched).join(
                rows.select("trip_id", *FACT_PARTITIONS), ["trip_id", *FACT_PARTITIONS], "left_anti"
            )
            rows = held.select(*rows.columns).unionByName(rows)
        # a partition is not replaced while it is read
        staged = scratch_dir(house.spark, "fact-staged")
        rows.write.parquet(staged)
        house.overwrite(
            "fact_trips", house.spark.read.parquet(staged), FACT_PARTITIONS, sort=("pickup_date_key",)
        )
        note_touched(house, sources)
        # also the months that trips of these sources were picked up in before this batch
        rebuild_aggregates(house, touched_by(house, sources))

    _run(trips, apply, checkpoint)


def first_of_new(rows: DataFrame, held: DataFrame, keys: list[str]) -> DataFrame:
    """One row of each key that is not held, NULL being one key; each side is shuffled once."""
    # NULL equals NULL inside a struct, and the join takes the shuffle by it that the deduplication made
    key = F.struct(*keys).alias("_key")
    once = rows.select(key, *[c for c in rows.columns if c not in keys]).dropDuplicates(["_key"])
    return once.join(held.select(key), "_key", "left_anti").select("_key.*", *once.columns[1:]).select(*rows.columns)


def append_once(
    house: Warehouse, stream: DataFrame, table: str, keys: list[str], time: str, checkpoint: str, delay: str = "1 day"
) -> None:
    """Append one row per key; keys are remembered in state for ``delay``, not looked up.

    Rows of a key share their ``time`` (add it to the keys where they may not). What arrives is
    split at a high-water mark, the latest time of the batches before it less ``delay``. Rows
    above it pass a deduplication whose state is dropped as the watermark moves on, and the
    stored table is not read for them. Only rows below it, or without a time, are compared
    with the stored rows of their times. Each part has its own checkpoint and every batch
    replaces what it wrote, so a job that stopped anywhere goes on where it was.
    """
    spark, names = house.spark, [f.name for f in stream.schema.fields]
    arrivals, marks = f"{table}_arrivals", f"{table}_marks"

    def put(part: str, batch_id: int, rows: DataFrame) -> None:
        path = f"{house.path(part)}/batch_id={batch_id}"
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)

    def split(batch: DataFrame, batch_id: int) -> None:
        put(marks, batch_id, batch.agg(F.max(time).alias("high")))
        before = spark.read.parquet(house.path(marks)).filter(F.col("batch_id") < batch_id)
        high = before.agg((F.max("high").cast("timestamp") - F.expr(f"INTERVAL {delay}")).alias("mark")).first().mark
        late = F.col(time).isNull()
        if high is not None:
            late = late | (F.col(time).cast("timestamp") < F.lit(high))
        for part, rows in (("late", batch.filter(late)), ("timely", batch.filter(~late))):
            put(f"{arrivals}/{part}", batch_id, rows)

    def arrived(part: str) -> DataFrame:
        path = house.path(f"{arrivals}/{part}")
        return spark.readStream.schema(stream.schema).option("recursiveFileLookup", "true").parquet(path)

    def store(part: str, batch: DataFrame, batch_id: int) -> None:
        put(f"{table}/part={part}", batch_id, batch.select(*names))

    def store_late(batch: DataFrame, batch_id: int) -> None:
        spans = batch.agg(F.min(time).alias("low"), F.max(time).alias("high"), F.count_if(F.col(time).isNull()).alias("n")).first()
        earlier = house.read(table).filter((F.col("part") == "timely") | (F.col("batch_id") < batch_id))
        near = F.lit(False) if spans.low is None else F.col(time).between(spans.low, spans.high)
        if spans.n:
            near = near | F.col(time).isNull()
        store("late", first_of_new(batch, earlier.filter(near), keys), batch_id)

    _run(stream, split, f"{checkpoint}/split")
    timed = arrived("timely").withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", delay)
    once = timed.dropDuplicatesWithinWatermark(keys).drop("_time")
    _run(once, lambda batch, batch_id: store("timely", batch, batch_id), f"{checkpoint}/timely")
    _run(arrived("late"), store_late, f"{checkpoint}/late")


def keep_up(
    house: Warehouse, trips: DataFrame, checkpoint: str, sent: str = "processed_at", deleted: str | None = None
) -> DeltaFacts:
    """Take arriving, changed and deleted trips into a fact and aggregates kept by deltas."""
    kept = DeltaFacts(house)
    _run(trips, lambda batch, batch_id: kept.apply(batch, batch_id, sent, deleted), checkpoint)
    return kept


__all__ = [
    "append_and_recompute", "append_final_hours", "append_new", "append_once", "hourly_demand",
    "hours_so_far", "ingest", "keep_hours", "keep_up",
]
