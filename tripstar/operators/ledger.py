"""Append-only logs of files and runs, and the questions asked of them."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Order in which the facts of a month are built.
STEPS = ["fact_trips", "fact_trips_daily_agg", "fact_trips_hourly_agg"]
# The states of a monthly file.
MISSING, AVAILABLE, UPLOADED = "MISSING", "AVAILABLE", "UPLOADED"

LOAD_LOG = (
    "file_type string, year int, month int, status string, rows_in_file bigint, "
    "rows_loaded bigint, error_message string, seq bigint"
)
RUN_LOG = (
    "year int, month int, fact_table_name string, status string, record_count bigint, "
    "error_message string, load_number bigint, seq bigint"
)


def latest(log: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last entry per key.

    A maximum over structs, so long histories of one key are reduced inside the
    tasks instead of being sorted in one place.
    """
    payload = [c for c in log.columns if c not in keys and c not in order]
    last = F.max(F.struct(*order, *payload)).alias("last")
    return log.groupBy(*keys).agg(last).select(
        *keys, *[F.col(f"last.{c}").alias(c) for c in [*order, *payload]]
    ).select(*log.columns)


def steps_to_run(log: DataFrame, order: list[str], steps: list[str] = STEPS) -> DataFrame:
    """Steps of each logged month whose last entry is not ``loaded``, with that entry."""
    wanted = F.explode(F.array(*map(F.lit, steps))).alias("fact_table_name")
    last = F.max(F.struct(*order, "status")).alias("last")
    states = log.groupBy("year", "month").pivot("fact_table_name", steps).agg(last)
    status = F.coalesce(*[
        F.when(F.col("fact_table_name") == step, F.col(f"{step}.status")) for step in steps
    ])
    return (
        states.select("year", "month", *steps, wanted)
        .withColumn("last_status", status)
        .filter(F.col("last_status").isNull() | (F.col("last_status") != "loaded"))
        .select("year", "month", "fact_table_name", "last_status")
    )


def file_status_latest(events: DataFrame) -> DataFrame:
    """Current status of each monthly file."""
    return events.groupBy("year", "month", "file_type").agg(
        F.max_by("status", "seq").alias("status")
    )


def month_completeness(statuses: DataFrame, services: int = 3) -> DataFrame:
    """Months with the number of uploaded files, and whether that is all of them."""
    uploaded = F.count_if(F.col("status") == UPLOADED)
    return statuses.groupBy("year", "month").agg(
        uploaded.alias("uploaded"), (uploaded == services).alias("complete")
    )


def next_statuses(statuses: DataFrame, published: DataFrame, stored: DataFrame) -> DataFrame:
    """Files whose status moves on: published ones become available, stored ones uploaded.

    ``published`` and ``stored`` list monthly files by (year, month, file_type).
    """
    keys = ["year", "month", "file_type"]
    seen = statuses.join(
        published.select(*keys).distinct().withColumn("_published", F.lit(True)), keys, "left"
    ).join(stored.select(*keys).distinct().withColumn("_stored", F.lit(True)), keys, "left")
    moved = F.when((F.col("status") != UPLOADED) & F.col("_stored"), UPLOADED).when(
        (F.col("status") == MISSING) & F.col("_published"), AVAILABLE
    )
    return seen.withColumn("status", moved).filter(F.col("status").isNotNull()).select(
        *keys, "status"
    )


def reconcile(in_files: DataFrame, loaded: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key in the files and in the table, side by side, with the difference."""
    count = lambda rows, name: rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(name)
    )
    both = count(in_files, "rows_in_file").join(count(loaded, "rows_loaded"), keys, "full_outer")
    filled = both.fillna(0, ["rows_in_file", "rows_loaded"])
    return filled.withColumn("missing_rows", F.col("rows_in_file") - F.col("rows_loaded"))


SNAPSHOT_EVERY = 64  # appends, each a small file


class Ledger:
    """A log table: entries are appended, the last one per key counts.

    After some appends all entries so far are written as one snapshot file, and further ones
    go into a folder of their own that begins after it. A read lists the snapshots and opens
    the last of them and its short tail, however long the history. A snapshot that was not
    finished is not seen, and nothing is lost without it. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str]) -> None:
        self.spark, self.path, self.schema, self.keys = spark, path, schema, keys

    def _files(self, folder: str) -> list[str]:
        """Files below a folder; listed, not opened."""
        try:
            return self.spark.read.schema(self.schema).parquet(f"{self.path}/{folder}").inputFiles()
        except AnalysisException:
            return []

    def _snapshot(self) -> int:
        """Number of the last append that a snapshot holds; 0 before the first."""
        found = (re.search(r"upto=(\d+)/", f) for f in self._files("snapshots"))
        return max((int(m[1]) for m in found if m), default=0)

    def _tail(self, after: int) -> DataFrame | None:
        folder = f"tail/after={after}"
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{folder}") if self._files(folder) else None

    def read(self) -> DataFrame:
        after = self._snapshot()
        parts = [self._tail(after)]
        if after:
            parts.append(self.spark.read.schema(self.schema).parquet(f"{self.path}/snapshots/upto={after}"))
        found = [p for p in parts if p is not None]
        return reduce(DataFrame.unionAll, found) if found else self.spark.createDataFrame([], self.schema)

    def latest(self) -> DataFrame:
        return latest(self.read(), self.keys, ["seq"])

    def append(self, entries: DataFrame) -> None:
        """Append entries, numbered after all earlier ones."""
        after = self._snapshot()
        tail = self._tail(after)
        number = (after if tail is None else tail.agg(F.max("seq")).first()[0]) + 1
        entries = entries.withColumn("seq", F.lit(number).cast("bigint"))
        names = [c.split()[0] for c in self.schema.split(", ")]
        padded = entries.select(
            *[F.col(c) if c in entries.columns else F.lit(None).alias(c) for c in names]
        )
        typed = [
            F.col(c.split()[0]).cast(c.split()[1]) for c in self.schema.split(", ")
        ]
        padded.select(*typed).coalesce(1).write.mode("append").parquet(f"{self.path}/tail/after={after}")
        if number - after >= SNAPSHOT_EVERY:
            self.read().coalesce(1).write.mode("overwrite").parquet(f"{self.path}/snapshots/upto={number}")

    def record(self, **values: object) -> None:
        """Append one entry."""
        self.append(
            self.spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
        )

    def last_status(self, **key: object) -> str | None:
        matches = reduce(lambda a, b: a & b, [F.col(k) == v for k, v in key.items()])
        row = self.latest().filter(matches).select("status").first()
        return None if row is None else row[0]


# ---------------------------------------------------------------------------
# Reconciliation by content
# ---------------------------------------------------------------------------
def content_digest(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Number of rows and a fingerprint of their contents per key, whatever their order.

    The fingerprint adds up two halves of a 64-bit hash of each row, so repeated rows count as
    often as they occur. NULL differs from every value: which columns are NULL is hashed as well.
    """
    empty = F.array(*[F.col(c).isNull() for c in columns])
    digest = F.xxhash64(*columns, empty)
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(digest.bitwiseAND(F.lit(0xFFFFFFFF)).cast("decimal(12,0)")).alias("low"),
        F.sum(F.shiftrightunsigned(digest, 32).cast("decimal(12,0)")).alias("high"),
    )


def reconcile_contents(source: DataFrame, stored: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Per key: rows on either side, and whether their contents are the same multiset."""
    left = content_digest(source, keys, columns).select(*keys, "n", F.struct("n", "low", "high").alias("_left"))
    right = content_digest(stored, keys, columns).select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col("n").alias("_n"), F.struct("n", "low", "high").alias("_right")
    )
    same = [left[k].eqNullSafe(right[f"_{k}"]) for k in keys]
    test = same[0]
    for one in same[1:]:
        test = test & one
    return left.join(right, test, "full_outer").select(
        *[F.coalesce(k, f"_{k}").alias(k) for k in keys],
        F.coalesce("n", F.lit(0)).alias("source_rows"),
        F.coalesce("_n", F.lit(0)).alias("stored_rows"),
        F.col("_left").eqNullSafe(F.col("_right")).alias("same_content"),
    )
