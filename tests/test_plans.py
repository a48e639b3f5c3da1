"""What the plans must look like to hold at scale."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tripstar.catalog import stored
from tripstar.operators import facts
from tripstar.plans import load as loads
from tripstar.plans import marts
from tripstar.session import scratch_dir
from tripstar.sources import dimensions


def plan(frame) -> str:
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return dimensions.build_star(spark, stored.fact(spark, sf_dir), date(1995, 1, 1),
                                 date(2001, 12, 31))


def run_mart(tables, name):
    if name == "executive_kpis":
        return marts.executive_kpis(tables, date(2000, 6, 15))
    return marts.MARTS[name](tables)


@pytest.mark.parametrize("name", list(marts.MARTS))
def test_marts_stay_in_the_engine_and_broadcast_only_dimensions(tables, name):
    text = plan(run_mart(tables, name))
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "SortMergeJoin"):
        assert word not in text


def test_wide_mart_has_no_shuffle(tables):
    assert "hashpartitioning" not in plan(marts.trip_analytics(tables))


def test_month_range_reaches_the_scan(tables):
    text = plan(marts.executive_kpis(tables, date(2000, 6, 15)))
    assert "GreaterThanOrEqual(pickup_date_key,20000501)" in text
    month = plan(facts.daily_agg(facts.in_month(tables.fact_trips, 2000, 6)))
    assert "GreaterThanOrEqual(pickup_date_key,20000601)" in month


def test_only_needed_columns_are_read(tables):
    text = plan(marts.monthly_trends(tables))
    schema = next(line for line in text.splitlines() if line.startswith("ReadSchema"))
    assert "total_amount" in schema and "tip_amount" not in schema
    assert schema.count(":") - 1 == 5  # date, service, revenue, passengers, distance


def test_month_build_reads_one_partition(spark, sf_dir):
    from tripstar.schemas import PARTITIONS
    from tripstar.sources import testdata

    house = loads.Warehouse(spark, scratch_dir(spark, "house"))
    some = testdata.trips(spark, sf_dir).filter(F.col("year") == 1996)
    house.overwrite("trip_data", some, PARTITIONS)
    text = plan(facts.fact_trips(house.read("trip_data"), 1996, 3))
    assert "PartitionFilters" in text and "(year#" in text.split("PartitionFilters")[1][:200]


def test_anti_join_shuffles_each_side_once(tables):
    fact = tables.fact_trips
    frame = facts.not_yet_loaded(fact, fact.filter(F.col("store_fwd_flag") == "Y"))
    spark = fact.sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(frame)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.split("\n\n")[0].count("Exchange") == 2


def test_supplied_dimension_is_not_forced(spark, tables):
    places = spark.range(1000).select(
        F.col("id").cast("int").alias("location_id"), F.lit("z").alias("zone_name"),
        F.lit("b").alias("borough"), F.lit("s").alias("service_zone"),
        F.lit("t").alias("location_type"), F.lit(False).alias("is_airport"),
        F.lit(False).alias("is_manhattan"))
    wide = dimensions.build_star(spark, tables.fact_trips, dim_location=places)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(wide.attach(wide.fact_trips, "dim_location", "pickup_location_id",
                                {"zone": "zone_name"}))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text
