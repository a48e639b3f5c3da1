"""Loads, merges, ledgers and streams on small files."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripstar.operators import facts, ledger, upsert
from tripstar.plans import load as loads
from tripstar.session import scratch_dir
from tripstar.sources import raw_files, testdata
from tripstar.streaming import jobs


def write_source(spark, landing, service, year, month, rows, schema, part="a"):
    frame = spark.createDataFrame(rows, schema).coalesce(1)
    name = f"{service}_tripdata_{year}-{month:02d}.parquet"
    frame.write.mode("append").parquet(f"{landing}/{name}")


GREEN = "VendorID string, lpep_pickup_datetime string, PULocationID string, total_amount double"
YELLOW = "VendorID string, tpep_pickup_datetime string, PULocationID string, total_amount double"


def green(n, month=1, vendor="1"):
    return [(vendor, f"2024-{month:02d}-02 10:00:{i:02d}", "4", 10.0) for i in range(n)]


@pytest.fixture()
def house(spark):
    return loads.Warehouse(spark, scratch_dir(spark, "house"))


@pytest.fixture()
def landing(spark):
    return scratch_dir(spark, "landing")


def test_scan_one_month_and_ids(spark, landing):
    write_source(spark, landing, "green", 2024, 1, green(3), GREEN)
    write_source(spark, landing, "green", 2024, 1, green(3), GREEN)
    write_source(spark, landing, "green", 2024, 2, green(4), GREEN)
    write_source(spark, landing, "fhvhv", 2024, 1, [("x",)], "hvfhs_license_num string")
    assert raw_files.read_raw(spark, landing, "green", [(2024, 1)]).count() == 6
    everything = raw_files.read_raw(spark, landing, "green")
    assert everything.count() == everything.select("trip_id").distinct().count() == 10
    again = raw_files.read_raw(spark, landing, "green")
    assert again.select("trip_id").exceptAll(everything.select("trip_id")).count() == 0
    assert raw_files.months_present(spark, landing, "green") == [(2024, 1), (2024, 2)]
    scope = {r.file_type: r.in_scope for r in raw_files.file_inventory(spark, landing).collect()}
    assert scope == {"green": True, "fhvhv": False}


def test_load_is_idempotent_and_gated(spark, house, landing):
    write_source(spark, landing, "green", 2024, 1, green(5), GREEN)
    assert loads.load(house, landing, "green") == "loaded"
    assert loads.load(house, landing, "green") == "skipped"
    before = house.read("trip_data").collect()
    assert loads.load(house, landing, "green", force=True) == "loaded"
    assert sorted(house.read("trip_data").collect()) == sorted(before)
    write_source(spark, landing, "green", 2024, 2, green(2, 2), GREEN)
    assert loads.load(house, landing, "green") == "loaded"
    counts = {(r.year, r.month): (r.rows_in_file, r.rows_loaded)
              for r in house.load_log().latest().collect()}
    assert counts == {(2024, 1): (5, 5), (2024, 2): (2, 2)}


def test_rejects_are_set_aside(spark, house, landing):
    write_source(spark, landing, "yellow", 2024, 1, green(2) + green(1, vendor="bad"), YELLOW)
    loads.load(house, landing, "yellow")
    assert house.read("trip_data").count() == 2
    rejected = house.read("trip_rejects").first()
    assert rejected.bad_columns == "vendor_id"
    assert "bad" in rejected.row


def test_failing_service_does_not_stop_others(spark, house, landing):
    write_source(spark, landing, "green", 2024, 1, green(2), GREEN)
    outcomes = {r.file_type: r.status
                for r in loads.load_services(house, landing, ["yellow", "green"]).collect()}
    assert outcomes == {"yellow": "error", "green": "loaded"}


def test_fact_build_stops_at_a_failure_and_resumes(spark, house, landing, monkeypatch):
    write_source(spark, landing, "green", 2024, 1, green(4), GREEN)
    loads.load(house, landing, "green")
    working = loads.BUILDERS["fact_trips_daily_agg"]

    def broken(*_):
        raise RuntimeError("no space")

    monkeypatch.setitem(loads.BUILDERS, "fact_trips_daily_agg", broken)
    with pytest.raises(RuntimeError):
        loads.build_facts(house, 2024, 1)
    states = {r.fact_table_name: r.status for r in house.run_log().latest().collect()}
    assert states == {"fact_trips": "loaded", "fact_trips_daily_agg": "failed"}
    monkeypatch.setitem(loads.BUILDERS, "fact_trips_daily_agg", working)
    result = {r.fact_table_name: (r.status, r.record_count)
              for r in loads.build_facts(house, 2024, 1).collect()}
    assert result == {"fact_trips": ("loaded", 4), "fact_trips_daily_agg": ("loaded", 1),
                      "fact_trips_hourly_agg": ("loaded", 1)}


def test_upsert_keeps_other_columns_and_is_repeatable(spark):
    schema = "k int, v int, created string"
    old = spark.createDataFrame([(1, 10, "first"), (2, 20, "first")], schema)
    new = spark.createDataFrame([(2, None, "second"), (3, 30, "second")], schema)
    once = upsert.upsert(old, new, ["k"], ["v"])
    want = {(1, 10, "first"), (2, None, "first"), (3, 30, "second")}
    assert {tuple(r) for r in once.collect()} == want
    assert {tuple(r) for r in upsert.upsert(once, new, ["k"], ["v"]).collect()} == want
    assert {tuple(r) for r in upsert.insert_only(old, new, ["k"]).collect()} == {
        (1, 10, "first"), (2, 20, "first"), (3, 30, "second")}
    assert {tuple(r) for r in upsert.update_only(old, new, ["k"], ["v"]).collect()} == {
        (1, 10, "first"), (2, None, "first")}


def test_versioned_table_reads_while_replacing(spark):
    table = upsert.VersionedTable(spark, scratch_dir(spark, "versions"))
    first = spark.createDataFrame([(1, 10)], "k int, v int")
    table.merge(first, ["k"], ["v"])
    table.merge(spark.createDataFrame([(1, 11), (2, 20)], "k int, v int"), ["k"], ["v"])
    assert table.version() == 2
    assert {tuple(r) for r in table.read().collect()} == {(1, 11), (2, 20)}


def test_status_machine(spark):
    keys = "year int, month int, file_type string"
    statuses = spark.createDataFrame(
        [(2024, 1, "yellow", "MISSING"), (2024, 1, "green", "AVAILABLE"),
         (2024, 1, "fhv", "UPLOADED"), (2024, 2, "fhv", "MISSING")], keys + ", status string")
    published = spark.createDataFrame([(2024, 1, "yellow"), (2024, 1, "green")], keys)
    stored = spark.createDataFrame([(2024, 1, "green"), (2024, 1, "fhv")], keys)
    moved = ledger.next_statuses(statuses, published, stored)
    assert {(r.file_type, r.status) for r in moved.collect()} == {
        ("yellow", "AVAILABLE"), ("green", "UPLOADED")}
    full = ledger.month_completeness(
        spark.createDataFrame([(2024, 1, s, "UPLOADED") for s in ("a", "b", "c")],
                              keys + ", status string"))
    assert full.first().complete


def test_anti_join_with_one_hot_key(spark):
    """A third of all rows share one id; none may be lost or doubled."""
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("trip_id"))
    loaded = spark.range(0, 30000, 2).select(F.col("id").alias("trip_id"))
    got = facts.not_yet_loaded(rows, loaded).count()
    want = sum(1 for i in range(30000) if (7 if i % 3 == 0 else i) % 2 == 1)
    assert got == want


def test_stream_ingest_takes_new_files_once(spark, house, landing):
    checkpoint = scratch_dir(spark, "checkpoint")
    write_source(spark, landing, "green", 2024, 1, green(3), GREEN)
    jobs.ingest(house, landing, checkpoint, ["green"])
    jobs.ingest(house, landing, checkpoint, ["green"])
    assert house.read("trip_data").count() == 3
    write_source(spark, landing, "green", 2024, 1, green(2), GREEN)
    write_source(spark, landing, "green", 2024, 2, green(4, 2), GREEN)
    jobs.ingest(house, landing, checkpoint, ["green"])
    assert house.read("trip_data").count() == 9


def test_stream_dedupe_across_batches(spark, house):
    source = scratch_dir(spark, "ids")
    checkpoint = scratch_dir(spark, "checkpoint")
    schema = "trip_id bigint, n int"
    for batch in ([(1, 1), (1, 2), (2, 3)], [(2, 4), (3, 5)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        jobs.append_new(house, stream, "ids", "trip_id", checkpoint)
    assert sorted(r.trip_id for r in house.read("ids").collect()) == [1, 2, 3]


def test_late_trip_changes_the_month_it_was_picked_up_in(spark, house):
    from test_semantics import trip
    from tripstar.schemas import CONFORMED

    source, checkpoint = scratch_dir(spark, "late"), scratch_dir(spark, "checkpoint")
    arriving = [
        [trip(trip_id=1, total_amount=5)],
        [trip(trip_id=2, total_amount=7, month=2, pickup_datetime=datetime(2024, 1, 10, 9, 0))],
    ]
    for batch in arriving:
        spark.createDataFrame(batch, CONFORMED).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(CONFORMED).parquet(source)
        jobs.append_and_recompute(house, stream, checkpoint)
    row = house.read("fact_trips_daily_agg").first()
    assert (row.total_trips, float(row.total_revenue)) == (2, 12.0)


def test_streamed_trip_without_an_id_fails_the_batch(spark, house):
    from test_semantics import trip
    from tripstar.schemas import CONFORMED

    source, checkpoint = scratch_dir(spark, "no-id"), scratch_dir(spark, "checkpoint")
    rows = [trip(trip_id=None, total_amount=5), trip(trip_id=None, total_amount=7), trip(trip_id=1)]
    spark.createDataFrame(rows, CONFORMED).coalesce(1).write.parquet(source)
    with pytest.raises(Exception, match="no trip_id"):
        jobs.append_and_recompute(house, spark.readStream.schema(CONFORMED).parquet(source), checkpoint)


def test_load_counts_do_not_grow_with_the_months(spark, house, landing, monkeypatch):
    """One metric a pass, and the counts in the log are those of the files and of the table."""
    for month, n in ((1, 3), (2, 4), (3, 2)):
        rows = [*green(n, month), ("1", "garbage", "4", 1.0), ("1", f"2024-{month:02d}-02 10:00:00", "4", 1e12)]
        write_source(spark, landing, "green", 2024, month, rows, GREEN)
    write_source(spark, landing, "green", 2024, 4, [("1", "garbage", "4", 1.0)], GREEN)
    metrics = []
    observe = type(spark.range(1)).observe

    def counted(self, seen, *exprs):
        metrics.append(len(exprs))
        return observe(self, seen, *exprs)

    monkeypatch.setattr(type(spark.range(1)), "observe", counted)
    assert loads.load(house, landing, "green") == "loaded"
    assert metrics == [1]
    log = {(r.month, r.rows_in_file, r.rows_loaded) for r in house.load_log().latest().collect()}
    assert log == {(1, 5, 3), (2, 6, 4), (3, 4, 2), (4, 1, 0)}
    assert house.read("trip_rejects").count() == 3


def test_landing_is_shuffled_before_values_become_texts(spark, sf_dir):
    for service in ("yellow", "green", "fhv"):
        plan = testdata.landing_rows(spark, sf_dir, service)._jdf.queryExecution().optimizedPlan().toString()
        above, below = plan.split("RebalancePartitions")
        assert "date_format" in above and "date_format" not in below
