"""Facts kept up by signed deltas: old row minus, new row plus.

Trips arrive in numbered batches: new, late, sent again, moved to another time or place,
or deleted. A batch is stored as it comes; the rows it replaces are found by key among the
source months it touches; and what it changes is stored as signed sums and counts per key
of the daily and the hourly aggregate. No month is read or rewritten, and an aggregate is
its base plus the deltas. From time to time deltas are folded into the base, which
rewrites only the months that they touch.

Each table has one folder per batch, replaced as a whole, and a batch is compared with
earlier ones only, so a batch that is retried leaves the same tables. A trip keeps its
source month, and the row sent last counts (``sent``), in whatever order batches arrive.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstar.operators import facts
from tripstar.operators.partials import add_up, signed
from tripstar.operators.upsert import one_per_key, path_exists
from tripstar.plans.load import FACT_PARTITIONS, Warehouse, in_any_month
from tripstar.session import scratch_dir, splits

ID = ["trip_id", *FACT_PARTITIONS]
# What the aggregates count of a trip; the other columns are stored, and never compared.
COUNTED = [
    "pickup_date_key", "pickup_time_key", "pickup_location_id", "dropoff_location_id", "vendor_id",
    "passenger_count", "trip_distance", "trip_duration_minutes", "total_amount", "tip_amount", "fare_amount",
]
ROWS_A_SLICE = 2_000_000  # trips of a source month that one task sorts and writes


@dataclass(frozen=True)
class Kept:
    """An aggregate kept by deltas: its keys, its measures, and how it is reduced and shown."""

    keys: list[str]
    measures: list[str]
    rows: Callable[[DataFrame], DataFrame]
    show: Callable[[DataFrame], DataFrame]


AGGREGATES = {
    "daily": Kept(facts.DAILY_KEYS, facts.DAILY_MEASURES, facts.daily_rows, facts.daily_columns),
    "hourly": Kept(facts.HOURLY_KEYS, facts.HOURLY_MEASURES, facts.hourly_rows, facts.hourly_columns),
}


class DeltaFacts:
    """The trip fact and its aggregates in a warehouse, kept up batch by batch."""

    def __init__(self, house: Warehouse) -> None:
        self.house, self.spark = house, house.spark

    # -- tables ------------------------------------------------------------
    def _write(self, table: str, batch_id: int, rows: DataFrame, by: tuple[str, ...] = ()) -> None:
        """Replace what a batch left in a table, as a whole."""
        path = f"{self.house.path(table)}/batch_id={batch_id}"
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).parquet(path)

    def _read(self, table: str) -> DataFrame | None:
        path = self.house.path(table)
        return self.spark.read.parquet(path) if path_exists(self.spark, path) else None

    # -- a batch -----------------------------------------------------------
    def apply(self, trips: DataFrame, batch_id: int, sent: str = "processed_at", deleted: str | None = None) -> None:
        """Take a batch of conformed trips; of several rows of a trip the one sent last counts.

        A trip that comes without a pickup time, or with ``deleted``, is no row of the fact any
        more. A trip without an id could not be told from another, so it fails the batch.
        """
        gone = F.col("pickup_datetime").isNull()
        if deleted:
            gone = gone | F.coalesce(F.col(deleted), F.lit(False))
        marked = trips.withColumn("_gone", gone)
        # in one pass: a streamed batch is read with all its columns for every branch of a plan
        arrived = facts.fact_columns(marked, keep={"_sent": F.col(sent), "_dead": F.col("_gone")})
        # of a trip that is gone nothing is kept but its key
        left = {c: F.when(~F.col("_dead"), F.col(c)) for c in arrived.columns if c not in [*ID, "_sent", "_dead"]}
        no_id = F.raise_error(F.lit("a trip has no trip_id"))
        arrived = arrived.withColumns(left | {"trip_id": F.coalesce("trip_id", no_id)})
        self._write("delta_trips", batch_id, self._last_sent(arrived), tuple(FACT_PARTITIONS))
        stored = self._read("delta_trips")
        if stored is None:  # nothing has arrived so far
            return
        new = stored.filter(F.col("batch_id") == batch_id).select(*ID, "batch_id", "_sent", "_dead", *COUNTED)
        old = self._replaced(new, batch_id)
        if old is None:
            changes = new.filter("NOT _dead").withColumn("_sign", F.lit(1))
        else:
            before = F.struct(*[c for c in new.columns if c not in ID])
            pairs = old.select(*ID, F.col("last").alias("_old")).join(new.select(*ID, before.alias("_new")), ID, "right")
            pairs = pairs.withColumn("_stale", F.coalesce(F.col("_old._sent") > F.col("_new._sent"), F.lit(False)))
            lost = F.when(F.col("_stale"), F.col("_new.batch_id")).otherwise(F.col("_old.batch_id"))
            counted = lambda side: F.when(
                ~F.col(f"{side}._dead"), F.struct(*[F.col(f"{side}.{c}").alias(c) for c in COUNTED])
            )
            # a trip that counts as before, or that was overtaken, changes nothing
            moved = ~F.col("_stale") & ~counted("_old").eqNullSafe(counted("_new"))
            side = lambda name: F.when(moved, counted(name))
            # what is replaced and what changes is read three times, and found once
            staged = scratch_dir(self.spark, "delta-changes")
            pairs.select(
                *ID, F.when(F.col("_old").isNotNull(), lost).alias("of_batch"), side("_old").alias("_old"), side("_new").alias("_new")
            ).write.parquet(staged)
            found = self.spark.read.parquet(staged)
            self._write("delta_replaced", batch_id, found.filter("of_batch IS NOT NULL").select(*ID, "of_batch"))
            both = F.array(
                F.struct(F.lit(1).alias("_sign"), F.col("_new").alias("row")), F.struct(F.lit(-1).alias("_sign"), F.col("_old").alias("row"))
            )
            rows = found.filter("_new IS NOT NULL OR _old IS NOT NULL").select(*ID, F.explode(both).alias("_c"))
            changes = rows.filter("_c.row IS NOT NULL").select(*ID, "_c.row.*", F.col("_c._sign").alias("_sign"))
        for name, kept in AGGREGATES.items():
            rows = kept.rows(changes)
            delta = signed(rows, kept.keys, kept.measures, "_sign")
            unchanged = [F.col(c) == 0 for c in delta.columns if c not in kept.keys]
            same = unchanged[0]
            for test in unchanged[1:]:
                same = same & F.coalesce(test, F.lit(True))
            self._write(f"delta_{name}", batch_id, delta.filter(~same))

    @staticmethod
    def _last_sent(arrived: DataFrame) -> DataFrame:
        """One row per trip, those of a source month together: one shuffle serves both.

        Months of many rows are dealt to several tasks by id, so that none takes one whole.
        """
        months = arrived.groupBy(*FACT_PARTITIONS).agg(F.count(F.lit(1)).alias("n"))
        slices = F.lit(1)
        for r in months.filter(F.col("n") > ROWS_A_SLICE).collect():  # bounded by the calendar
            mine = [F.col(c).eqNullSafe(F.lit(r[c])) for c in FACT_PARTITIONS]
            slices = F.when(mine[0] & mine[1] & mine[2], splits(r.n, ROWS_A_SLICE)).otherwise(slices)
        placed = arrived.withColumn("_slice", F.pmod(F.xxhash64("trip_id"), slices))
        placed = placed.repartition(*FACT_PARTITIONS, "_slice")
        # months lead the keys, so the rows come out in the order they are written in
        return one_per_key(placed, [*FACT_PARTITIONS, "_slice", "trip_id"], ["_sent", "_dead"]).drop("_slice")

    def _replaced(self, new: DataFrame, batch_id: int) -> DataFrame | None:
        """The last earlier row of each trip of a batch, from the source months it touches.

        Ids of a source lie together, so row groups outside the range of the batch's are skipped.
        """
        held = self._read("delta_trips").filter(F.col("batch_id") < batch_id)
        bounds = new.groupBy("source_year", "source_month").agg(F.min("trip_id").alias("low"), F.max("trip_id").alias("high"))
        months = bounds.collect()  # bounded by the calendar
        if not months or batch_id == 0:
            return None
        touched = in_any_month([(r.source_year, r.source_month) for r in months], "source_year", "source_month")
        low, high = min(r.low for r in months), max(r.high for r in months)
        near = held.filter(touched & F.col("trip_id").between(low, high)).select(*new.columns)
        wanted = near.join(new.select(*ID), ID, "left_semi")
        row = F.struct(*[c for c in new.columns if c not in ID])
        return wanted.groupBy(*ID).agg(F.max_by(row, F.struct("_sent", "batch_id")).alias("last"))

    # -- what is current ---------------------------------------------------
    def fact(self) -> DataFrame:
        """The rows of the fact that count: those no later row of their trip replaced."""
        rows = self._read("delta_trips").filter("NOT _dead")
        replaced = self._read("delta_replaced")
        if replaced is not None:
            replaced = replaced.select(*ID, F.col("of_batch").alias("batch_id"))
            rows = rows.join(replaced, [*ID, "batch_id"], "left_anti")
        return rows.drop("batch_id", "_sent", "_dead")

    def aggregate(self, name: str) -> DataFrame:
        """The daily or hourly aggregate: its base and the deltas since, added up."""
        kept = AGGREGATES[name]
        return kept.show(self._state(name).filter("trips <> 0"))

    def _state(self, name: str) -> DataFrame:
        kept, folded = AGGREGATES[name], self._folds(name)
        parts = self._read(f"delta_{name}").filter(F.col("batch_id") > max((f[0] for f in folded), default=-1))
        states = [parts.drop("batch_id")]
        if folded:
            states.append(self._base(name, folded).drop("fold", "year", "month"))
        rows = states[0] if len(states) == 1 else states[0].unionByName(states[1])
        return add_up(rows, kept.keys)

    # -- folding -----------------------------------------------------------
    def fold(self, name: str) -> int:
        """Add the deltas so far to the base; only months with deltas are rewritten.

        The new files count once they are noted, so a fold that dies changes nothing.
        Returns the number of months written.
        """
        kept, folded = AGGREGATES[name], self._folds(name)
        done = max((f[0] for f in folded), default=-1)
        deltas = self._read(f"delta_{name}").filter(F.col("batch_id") > done)
        last = deltas.agg(F.max("batch_id")).first()[0]
        if last is None:
            return 0
        dated = self._dated(deltas.filter(F.col("batch_id") <= last).drop("batch_id"))
        months = sorted((r.year, r.month) for r in dated.select("year", "month").distinct().collect())
        if folded:
            base = self._base(name, folded).filter(in_any_month(months)).drop("fold")
            dated = dated.unionByName(base)
        state = add_up(dated, [*kept.keys, "year", "month"]).filter("trips <> 0").hint("rebalance", "year", "month")
        path = f"{self.house.path(f'base_{name}')}/fold={last}"
        state.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("year", "month").parquet(path)
        noted = self.spark.createDataFrame([(last, y, m) for y, m in months], "fold bigint, year int, month int")
        noted.coalesce(1).write.mode("append").parquet(self.house.path(f"folds_{name}"))
        return len(months)

    @staticmethod
    def _dated(rows: DataFrame) -> DataFrame:
        key = F.col("date_key")
        return rows.withColumns({
            "year": F.floor(key / 10000).cast("int"), "month": (F.floor(key / 100) % 100).cast("int"),
        })

    def _folds(self, name: str) -> list[tuple]:
        """(fold, year, month): the last fold of each month; bounded by the calendar."""
        noted = self._read(f"folds_{name}")
        if noted is None:
            return []
        return [(r.fold, r.year, r.month) for r in noted.groupBy("year", "month").agg(F.max("fold").alias("fold")).collect()]

    def _base(self, name: str, folded: list[tuple]) -> DataFrame:
        by_fold: dict[int, list[tuple]] = {}
        for fold, year, month in folded:
            by_fold.setdefault(fold, []).append((year, month))
        test = F.lit(False)
        for fold, months in by_fold.items():
            test = test | ((F.col("fold") == fold) & in_any_month(months))
        return self._read(f"base_{name}").filter(test)
