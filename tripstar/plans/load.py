"""Loading monthly sources and building facts on tables of files."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripstar.functions import temporal
from tripstar.functions.temporal import month_ranges
from tripstar.operators import facts, summaries
from tripstar.operators.ledger import LOAD_LOG, RUN_LOG, STEPS, Ledger
from tripstar.operators.normalize import sort_out
from tripstar.operators.upsert import merge_partitions, path_exists
from tripstar.schemas import CONFORMED, PARTITIONS, SERVICES
from tripstar.sources import raw_files
from tripstar.sources.raw_files import Months, months_present

FACT_PARTITIONS = ["file_type", "source_year", "source_month"]
AGG_PARTITIONS = ["year", "month"]
MONTHS_A_JOB = 24  # a load job keeps two bits for each month, in one long

# A load writes one table by outcome; these are its two halves.
_HALVES = {"trip_data": "trip_rows/outcome=good", "trip_rejects": "trip_rows/outcome=rejected"}
_REJECT_COLUMNS = [*PARTITIONS, "trip_id", "bad_columns", "row"]
_FILES = "path string, year int, month int, number int, file_type string"
_TOUCHED = "year int, month int, source_year int, source_month int"


@dataclass(frozen=True)
class Warehouse:
    """Folders of the tables under one root."""

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root}/{_HALVES.get(table, table)}"

    def read(self, table: str) -> DataFrame:
        if table not in _HALVES:
            return self.spark.read.parquet(self.path(table))
        # the halves share their columns; one that has no rows yet is an empty table
        wide = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in CONFORMED.fields)}, bad_columns string, row string"
        if self.has(table):
            rows = self.spark.read.schema(wide).parquet(self.path(table))
        else:
            rows = self.spark.createDataFrame([], wide)
        return rows.select(*(CONFORMED.names if table == "trip_data" else _REJECT_COLUMNS))

    def has(self, table: str) -> bool:
        return path_exists(self.spark, self.path(table))

    def load_log(self) -> Ledger:
        return Ledger(self.spark, self.path("load_log"), LOAD_LOG, PARTITIONS)

    def run_log(self) -> Ledger:
        keys = ["year", "month", "fact_table_name"]
        return Ledger(self.spark, self.path("run_log"), RUN_LOG, keys)

    def overwrite(
        self, table: str, rows: DataFrame, by: list[str], clustered: bool = False,
        sort: tuple[str, ...] = (),
    ) -> None:
        """Replace the partitions that occur in ``rows``; others stay as they are.

        Rows that already lie together by partition (read from monthly files, or from
        a table with the same partitions) are ``clustered``: each task writes its few
        partitions and nothing is shuffled. Other rows are rebalanced first, so that a
        small partition gets one file and one with a large share of the rows is split.
        """
        placed = rows if clustered else rows.hint("rebalance", *by)
        if sort:
            placed = placed.sortWithinPartitions(*by, *sort)
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            *by
        ).parquet(self.path(table))

    def clear(self, table: str, by: list[str], partitions: list[tuple]) -> None:
        """Leave no rows in some partitions, which no rows to write would otherwise keep."""
        for values in partitions:
            folder = "/".join(f"{k}={v}" for k, v in zip(by, values, strict=True))
            empty = self.spark.createDataFrame([], self.read(table).drop(*by).schema)
            empty.write.mode("overwrite").parquet(f"{self.path(table)}/{folder}")

    def sizes(self, table: str, by: list[str], test: Column) -> dict[tuple, int]:
        """Rows of each partition that holds any; only footers are read. Bounded by the calendar."""
        if not self.has(table):
            return {}
        counts = self.read(table).filter(test).groupBy(*by).count()
        return {tuple(r[k] for k in by): r["count"] for r in counts.collect()}

    def filled(self, table: str, by: list[str], test: Column) -> set[tuple]:
        """Partitions that hold rows."""
        return set(self.sizes(table, by, test))


def load(
    house: Warehouse,
    landing: str,
    service: str,
    months: Months | None = None,
    processed_at: Column | None = None,
    force: bool = False,
) -> str:
    """Load a service's sources of the given months, or of all months found.

    Months recorded as loaded are skipped unless forced. Loading again replaces the same
    partitions, also those that come out empty, so a repeated or retried load leaves the
    same table. Rows that do not convert go to ``trip_rejects``. A month without files,
    or with a file that cannot be read, is recorded with its error and the others are
    loaded. Returns ``loaded``, ``incomplete`` or ``skipped``; raises if no month loads.
    """
    log = house.load_log()
    present = months_present(house.spark, landing, service)
    found = months if months is not None else present
    if not found:
        raise FileNotFoundError(f"no sources of {service}")
    done = set() if force else _loaded_months(log, service)
    wanted = [month for month in found if month not in done]
    if not wanted:
        return "skipped"
    there = set(present)
    failed: dict[tuple[int, int], Exception] = {
        m: FileNotFoundError(f"no sources of {service} for {m[0]:04d}-{m[1]:02d}")
        for m in wanted if m not in there
    }
    readable = [m for m in wanted if m in there]
    groups, unreadable = raw_files.schema_groups(house.spark, landing, service, readable)
    failed |= unreadable
    files = _registered_files(house, landing, service, readable) if groups else None
    loaded: list[tuple] = []
    for schema, own in groups.items():
        for at in range(0, len(own), MONTHS_A_JOB):
            part = own[at : at + MONTHS_A_JOB]
            try:
                raw = raw_files.read_group(house.spark, landing, service, part, schema, files)
                loaded += _load_group(house, raw, service, part, processed_at)
            except Exception as error:  # noqa: BLE001 - a bad file stops only its own month
                if len(part) == 1:
                    failed[part[0]] = error
                    continue
                for month in part:
                    try:
                        raw = raw_files.read_group(house.spark, landing, service, [month], schema, files)
                        loaded += _load_group(house, raw, service, [month], processed_at)
                    except Exception as own_error:  # noqa: BLE001
                        failed[month] = own_error
    entries = [(service, *m, "loaded", n, kept, None) for m, n, kept in loaded]
    entries += [(service, *m, "error", None, None, str(e)) for m, e in sorted(failed.items())]
    log.append(house.spark.createDataFrame(entries, LOAD_LOG.rpartition(",")[0]))
    if failed and not loaded:
        raise next(iter(failed.values()))
    return "incomplete" if failed else "loaded"


def _registered_files(house: Warehouse, landing: str, service: str, months: Months) -> DataFrame:
    """Numbers of the files of a service, kept in a table: a late file gets a new one."""
    def known() -> DataFrame:
        if not house.has("file_registry"):
            return house.spark.createDataFrame([], _FILES)
        rows = house.spark.read.schema(_FILES).parquet(house.path("file_registry"))
        return rows.filter(F.col("file_type") == service)

    listed = raw_files.listed_files(house.spark, landing, service, months)
    new = raw_files.numbered_files(listed, known()).select("path", "year", "month", F.col("number").cast("int").alias("number"))
    new.withColumn("file_type", F.lit(service)).write.mode("append").partitionBy("file_type").parquet(
        house.path("file_registry")
    )
    return known()


def _load_group(
    house: Warehouse, raw: DataFrame, service: str, months: Months, processed_at: Column | None
) -> list[tuple]:
    """Write good and rejected rows in one pass; (month, rows in its files, rows loaded)."""
    rows = sort_out(raw, service, processed_at)
    seen = Observation()
    # the pass notes which partitions get rows; how many they got is in the footers
    outcomes = ["good", "rejected"]
    place = F.array_position(F.array(*[F.lit(y * 12 + m) for y, m in months]), F.col("year") * 12 + F.col("month"))
    half = F.array_position(F.array(*map(F.lit, outcomes)), F.col("outcome"))
    bit = F.when(half > 0, F.call_function("shiftleft", F.lit(1).cast("long"), (place * 2 + half - 3).cast("int")))
    kept = rows.observe(seen, F.bit_or(bit).alias("filled")).filter(F.col("outcome") != "dropped")
    house.overwrite("trip_rows", kept, ["outcome", *PARTITIONS], clustered=True)
    filled = seen.get["filled"] or 0
    got = {(o, *m) for i, m in enumerate(months) for j, o in enumerate(outcomes) if filled >> (2 * i + j) & 1}
    mine = (F.col("file_type") == service) & in_any_month(months)
    for table, name in (("trip_data", "good"), ("trip_rejects", "rejected")):
        empty = {(service, *m) for m in months if (name, *m) not in got}
        if empty:
            house.clear(table, PARTITIONS, sorted(house.filled(table, PARTITIONS, mine) & empty))
    in_files = {(r.year, r.month): r["count"] for r in raw.groupBy("year", "month").count().collect()}
    loaded = house.sizes("trip_data", PARTITIONS, mine) if any(o == "good" for o, *_ in got) else {}
    return [(m, in_files.get(m, 0), loaded.get((service, *m), 0)) for m in months]


def _loaded_months(log: Ledger, service: str) -> set[tuple[int, int]]:
    """Months recorded as loaded; their number is bounded by the calendar."""
    done = log.latest().filter((F.col("file_type") == service) & (F.col("status") == "loaded"))
    return {(row.year, row.month) for row in done.select("year", "month").collect()}


def in_any_month(months: Months, year: str = "year", month: str = "month") -> Column:
    """Test for some partitions by year and month; prunes the scan."""
    by_year: dict[int, list[int]] = {}
    for y, m in months:
        by_year.setdefault(y, []).append(m)
    tests = [(F.col(year) == y) & F.col(month).isin(m) for y, m in by_year.items()]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def load_services(
    house: Warehouse,
    landing: str,
    services: list[str] = SERVICES,
    months: Months | None = None,
    processed_at: Column | None = None,
    force: bool = False,
) -> DataFrame:
    """Load several services; one that fails does not stop the others.

    Returns one row per service with its outcome.
    """
    outcomes = []
    for service in services:
        try:
            status, error = load(house, landing, service, months, processed_at, force), None
        except Exception as failure:  # noqa: BLE001 - kept in the outcome and the log
            status, error = "error", type(failure).__name__
        outcomes.append((service, status, error))
    return house.spark.createDataFrame(outcomes, "file_type string, status string, error string")


# ---------------------------------------------------------------------------
# Facts
# ---------------------------------------------------------------------------
def build_facts(
    house: Warehouse, year: int | None = None, month: int | None = None, force: bool = False
) -> DataFrame:
    """Build the trip fact, then the daily, then the hourly aggregate; stop at a failure.

    With a month, steps of it recorded as loaded are skipped unless forced. Without one,
    each step takes the source months loaded since it last took them. Aggregates are
    built for every pickup month that those source months hold, strays included. Each
    step leaves a ``started`` and then a ``loaded`` or ``failed`` entry. Returns the
    last log entry of each step; year and month 0 stand for all.
    """
    log = house.run_log()
    whole = year is None or month is None
    scope = {"year": 0, "month": 0} if whole else {"year": year, "month": month}
    loads = _load_numbers(house)
    for step in STEPS:
        if whole:
            built = _built_numbers(log, step)
            months = sorted(m for m, n in loads.items() if force or built.get(m, -1) < n)
        else:
            months = [(year, month)]
            if not force and log.last_status(**scope, fact_table_name=step) == "loaded":
                continue
        if not months and log.last_status(**scope, fact_table_name=step) == "loaded":
            continue
        log.record(**scope, fact_table_name=step, status="started")
        try:
            rows = BUILDERS[step](house, months)
        except Exception as error:
            log.record(**scope, fact_table_name=step, status="failed", error_message=str(error))
            raise
        entries = [(*m, step, "loaded", None, None, loads.get(m, 0)) for m in months if whole]
        entries.append((scope["year"], scope["month"], step, "loaded", rows, None, loads.get((year, month), 0)))
        schema = "year int, month int, fact_table_name string, status string, record_count bigint, " \
            "error_message string, load_number bigint"
        log.append(house.spark.createDataFrame(entries, schema))
    return log.latest().filter(
        (F.col("year") == scope["year"]) & (F.col("month") == scope["month"])
    )


def _load_numbers(house: Warehouse) -> dict[tuple[int, int], int]:
    """The last load of each source month; 0 where the table was filled without a load."""
    present = {(y, m): 0 for _, y, m in house.filled("trip_data", PARTITIONS, F.lit(True))}
    logged = house.load_log().read().filter(F.col("status") == "loaded")
    last = logged.groupBy("year", "month").agg(F.max("seq").alias("n")).collect()
    return present | {(r.year, r.month): r.n for r in last}


def _built_numbers(log: Ledger, step: str) -> dict[tuple[int, int], int]:
    """The load of each source month that a step last took."""
    done = log.latest().filter((F.col("fact_table_name") == step) & (F.col("status") == "loaded"))
    return {(r.year, r.month): r.load_number or 0 for r in done.filter("year > 0").collect()}


def build_fact_trips(house: Warehouse, months: Months) -> int:
    """Replace the fact partitions of some source months; returns the row count of the fact's.

    Ids are fixed by the source files, so replacing a month's partition is what
    keeps a trip from entering twice; no join against the whole fact is needed.
    """
    source = house.read("trip_data").filter(in_any_month(months))
    rows = facts.fact_trips(source)
    mine = in_any_month(months, "source_year", "source_month")
    before = house.filled("fact_trips", FACT_PARTITIONS, mine)
    note_touched(house, months)  # what the partitions hold now will be gone
    house.overwrite("fact_trips", rows, FACT_PARTITIONS, clustered=True, sort=("pickup_date_key",))
    full = house.filled("trip_data", PARTITIONS, in_any_month(months))
    house.clear("fact_trips", FACT_PARTITIONS, sorted(before - full))
    note_touched(house, months)
    return house.read("fact_trips").filter(mine).count()


def note_touched(house: Warehouse, sources: Months) -> None:
    """Add the pickup months that the fact holds for some source months to what is known.

    Kept by source month: aggregates are rebuilt for these months, and a rebuild opens
    only the source partitions that hold its month.
    """
    if not house.has("fact_trips"):
        return
    mine = in_any_month(sources, "source_year", "source_month")
    month = temporal.month_of_key(F.col("pickup_date_key"))
    held = (
        house.read("fact_trips").filter(mine)
        .select(F.floor(month / 100).cast("int").alias("year"), (month % 100).cast("int").alias("month"),
                "source_year", "source_month")
        .distinct()
    )
    known = _touched(house).filter(mine)
    rows = [tuple(r) for r in held.union(known.select(*held.columns)).distinct().collect()]
    if rows:  # bounded by the calendar
        frame = house.spark.createDataFrame(rows, _TOUCHED).coalesce(1)
        house.overwrite("touched_months", frame, ["source_year", "source_month"], clustered=True)


def _touched(house: Warehouse) -> DataFrame:
    if not house.has("touched_months"):
        return house.spark.createDataFrame([], _TOUCHED)
    return house.spark.read.schema(_TOUCHED).parquet(house.path("touched_months"))


def touched_by(house: Warehouse, sources: Months) -> Months:
    """Pickup months that trips of some source months have or had."""
    rows = _touched(house).filter(in_any_month(sources, "source_year", "source_month"))
    return sorted((r.year, r.month) for r in rows.select("year", "month").distinct().collect())


def _of_pickup_months(house: Warehouse, months: Months) -> DataFrame:
    """Fact rows picked up in some months, from the source partitions that hold them."""
    rows = _touched(house).filter(in_any_month(months)).select("source_year", "source_month").distinct()
    sources = [(r.source_year, r.source_month) for r in rows.collect()]
    # months mostly follow each other: a test for each would be made for every trip
    ranges = [F.col("pickup_date_key").between(*run) for run in month_ranges(months)]
    return house.read("fact_trips").filter(in_any_month(sources, "source_year", "source_month")).filter(
        reduce(lambda a, b: a | b, ranges, F.lit(False))
    )


def write_agg(house: Warehouse, table: str, build, months: Months) -> int:
    """Replace the given pickup months of an aggregate, also those left empty; its row count."""
    key = F.col("date_key")
    dated = build(_of_pickup_months(house, months)).withColumns({
        "year": F.floor(key / 10000).cast("int"),
        "month": (F.floor(key / 100) % 100).cast("int"),
    })
    before = house.filled(table, AGG_PARTITIONS, in_any_month(months))
    seen = Observation()
    test = [(F.col("year") == y) & (F.col("month") == m) for y, m in months]
    counts = [F.count_if(t).alias(f"rows{i}") for i, t in enumerate(test)]
    house.overwrite(table, dated.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), AGG_PARTITIONS)
    got = seen.get
    house.clear(table, AGG_PARTITIONS, sorted(m for i, m in enumerate(months) if not got[f"rows{i}"] and m in before))
    return got["rows"]


def _build_agg(table: str, build):
    return lambda house, months: write_agg(house, table, build, touched_by(house, months))


BUILDERS = {
    "fact_trips": build_fact_trips,
    "fact_trips_daily_agg": _build_agg("fact_trips_daily_agg", facts.daily_agg),
    "fact_trips_hourly_agg": _build_agg("fact_trips_hourly_agg", facts.hourly_agg),
}


def rebuild_aggregates(house: Warehouse, months: Months) -> None:
    """Recompute both aggregates for the given pickup months, in one job each."""
    if months:
        write_agg(house, "fact_trips_daily_agg", facts.daily_agg, months)
        write_agg(house, "fact_trips_hourly_agg", facts.hourly_agg, months)


# ---------------------------------------------------------------------------
# Summaries
# ---------------------------------------------------------------------------
SUMMARIES = {
    "fact_trip_summary": (summaries.trip_summary, summaries.MONTH),
    "fact_fare_summary": (summaries.fare_summary, summaries.MONTH),
    "fact_trip_locations": (summaries.trip_locations, summaries.ROUTE),
}


def update_summaries(house: Warehouse, trips: DataFrame) -> None:
    """Merge the three summaries of the file months in ``trips``; other months stay."""
    for table, (summarise, keys) in SUMMARIES.items():
        rows = summarise(trips)
        others = [c for c in rows.columns if c not in keys]
        merge_partitions(house.spark, house.path(table), rows, keys, others, AGG_PARTITIONS)
