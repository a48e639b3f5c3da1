"""Tables the registered queries share, written once per session.

Summaries and marts read stored trips and a stored fact, and normalisation reads
stored raw files, as they do in a warehouse. All are made by Spark from the whole test tables,
and what a scan gives is written without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripstar.catalog.oracle_base import CALENDAR
from tripstar.operators import facts, rollups
from tripstar.operators.upsert import path_exists
from tripstar.session import scratch_dir
from tripstar.sources import dimensions, testdata
from tripstar.star import Star

_paths: dict[tuple[str, str, str], str] = {}
_stars: dict[tuple[str, str, str], Star] = {}


def _key(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, str, str]:
    return spark.sparkContext.applicationId, sf_dir, name


def stored_path(
    spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None], proof: str = ""
) -> str:
    """Folder of a shared table, or of several with ``proof`` the last of them; written on first use."""
    key = _key(spark, sf_dir, name)
    if key not in _paths or not path_exists(spark, f"{_paths[key]}/{proof}".rstrip("/")):
        path = scratch_dir(spark, name)
        write(path)
        _paths[key] = path
    return _paths[key]


def _stored(
    spark: SparkSession, sf_dir: str, name: str, rows: Callable[[], DataFrame]
) -> DataFrame:
    def write(path: str) -> None:
        # as the tasks have them: files are read by row groups, so few large ones do no harm
        rows().write.parquet(path)

    return spark.read.parquet(stored_path(spark, sf_dir, name, write))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "trips", lambda: testdata.trips(spark, sf_dir))


def trip_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id and pickup of the trips that have one, without the other columns, which would be written for nothing."""
    times = lambda: testdata.trips(spark, sf_dir).filter("pickup_datetime IS NOT NULL").select("trip_id", "pickup_datetime")
    return _stored(spark, sf_dir, "trip-times", times)


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    # without the trips on the way, which a mart would write for nothing else
    return _stored(spark, sf_dir, "fact", lambda: facts.fact_trips(testdata.trips(spark, sf_dir)))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "daily", lambda: facts.daily_agg(fact(spark, sf_dir)))


def with_repeats(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The daily and the hourly aggregate as appends that ran twice would leave them."""
    hourly = _stored(spark, sf_dir, "hourly", lambda: facts.hourly_agg(fact(spark, sf_dir)))
    twice = {"daily": (daily(spark, sf_dir), "vendor_id = 2"), "hourly": (hourly, "time_key >= 2200")}
    return tuple(
        _stored(spark, sf_dir, f"{name}-repeats", lambda rows=rows, test=test: rows.unionAll(rows.filter(test)))
        for name, (rows, test) in twice.items()
    )


def daily_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct members per day and service, built from the stored daily aggregate alone."""
    return _stored(spark, sf_dir, "daily-sets", lambda: rollups.daily_sets(daily(spark, sf_dir)))


def slot_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue classes per day, hour and service."""
    return _stored(spark, sf_dir, "slot-revenue", lambda: rollups.slot_revenue(fact(spark, sf_dir)))


def star(spark: SparkSession, sf_dir: str) -> Star:
    fact_trips = fact(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir, _paths[_key(spark, sf_dir, "fact")])
    if key not in _stars:
        _stars[key] = dimensions.build_star(spark, fact_trips, *CALENDAR)
    return _stars[key]


def raw(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    build = testdata.raw_high_volume if service == "fhvhv" else (
        lambda s, d: testdata.raw(s, d, service)
    )
    return _stored(spark, sf_dir, f"raw-{service}", lambda: build(spark, sf_dir))


def landing(spark: SparkSession, sf_dir: str) -> str:
    """Monthly sources, one folder per service and month."""
    return stored_path(
        spark, sf_dir, "landing", lambda p: testdata.write_landing(spark, sf_dir, p)
    )
