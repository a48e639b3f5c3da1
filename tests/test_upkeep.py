"""Facts kept by deltas, stored sets and quantiles, dedupe in state: against a rebuild."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tripstar.catalog import stored, upkeep
from tripstar.operators import facts, rollups
from tripstar.plans import load as loads
from tripstar.plans import rollup_marts
from tripstar.plans.deltas import DeltaFacts
from tripstar.schemas import CONFORMED
from tripstar.session import scratch_dir
from tripstar.streaming import jobs

SENT = "sent int, deleted boolean"


def plan(frame) -> str:
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture()
def house(spark):
    return loads.Warehouse(spark, scratch_dir(spark, "house"))


def trips(spark, rows: list[dict]):
    """Conformed trips with their number of sending; columns that are not given are NULL."""
    names = CONFORMED.names
    values = [tuple(r.get(n) for n in [*names, "sent", "deleted"]) for r in rows]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CONFORMED.fields)
    return spark.createDataFrame(values, f"{schema}, {SENT}")


def trip(i: int, sent: int, day: str | None, amount: float | None = 10.0, month: int = 1, **more) -> dict:
    pickup = None if day is None else datetime.fromisoformat(f"{day} 10:30:00")
    money = None if amount is None else Decimal(f"{amount:.2f}")
    return {
        "trip_id": i, "file_type": "yellow", "year": 2024, "month": month, "processed_at": datetime(2025, 1, 1),
        "pickup_datetime": pickup, "dropoff_datetime": None if pickup is None else pickup + timedelta(minutes=7),
        "passenger_count": 1, "trip_distance": Decimal("2.50"), "total_amount": money, "fare_amount": money,
        "tip_amount": Decimal("1.00"), "vendor_id": 1, "pu_location_id": 4, "do_location_id": 5, "sent": sent, "deleted": False,
        **more,
    }


def rows_of(frame) -> list[tuple]:
    return sorted((tuple(r) for r in frame.select(*sorted(frame.columns)).collect()), key=str)


def same_as_rebuilt(kept: DeltaFacts) -> None:
    fact = kept.fact()
    assert rows_of(kept.aggregate("daily")) == rows_of(facts.daily_agg(fact))
    assert rows_of(kept.aggregate("hourly")) == rows_of(facts.hourly_agg(fact))


def test_deltas_equal_a_rebuild_after_every_batch(spark, house):
    kept = DeltaFacts(house)
    kept.apply(trips(spark, [trip(1, 1, "2024-01-05"), trip(2, 1, "2024-01-05", None), trip(3, 1, "2024-01-06", 5)]), 0, "sent", "deleted")
    same_as_rebuilt(kept)
    # moved to another month and priced anew; sent again unchanged; late; deleted
    second = [trip(1, 2, "2024-03-01", 20), trip(2, 2, "2024-01-05", None), trip(9, 2, "2024-01-05"), trip(3, 2, "2024-01-06", deleted=True)]
    for _ in range(2):  # a batch that is retried
        kept.apply(trips(spark, second), 1, "sent", "deleted")
        same_as_rebuilt(kept)
    assert sorted(r.trip_id for r in kept.fact().collect()) == [1, 2, 9]
    assert {r.date_key: r.total_trips for r in kept.aggregate("daily").collect()} == {20240301: 1, 20240105: 2}
    for name in ("daily", "hourly"):
        assert kept.fold(name) == 2 and kept.fold(name) == 0
    same_as_rebuilt(kept)
    # overtaken (sent before what is held), then back after a deletion, and a pickup that is withdrawn
    third = [trip(1, 1, "2024-01-05"), trip(3, 4, "2024-02-01", 7), trip(9, 3, None), trip(2, 3, "2024-01-05", 8)]
    kept.apply(trips(spark, third), 2, "sent", "deleted")
    same_as_rebuilt(kept)
    assert sorted(r.trip_id for r in kept.fact().collect()) == [1, 2, 3]
    assert kept.fold("daily") == 2 and rows_of(kept.aggregate("daily")) == rows_of(facts.daily_agg(kept.fact()))
    # several rows of a trip in one batch: the last sent counts
    kept.apply(trips(spark, [trip(2, 6, "2024-02-09", 1), trip(2, 7, "2024-02-10", 2), trip(2, 5, "2024-02-11", 3)]), 3, "sent", "deleted")
    same_as_rebuilt(kept)
    assert {r.trip_id: r.pickup_date_key for r in kept.fact().collect()}[2] == 20240210


def test_deltas_of_random_batches_in_any_order(spark):
    rng = random.Random(6)
    last: dict[int, dict] = {}
    batches = []
    for b in range(4):
        rows = {}
        for _ in range(40):
            i = rng.randrange(60)
            day = None if rng.random() < 0.05 else f"2024-{rng.randint(1, 3):02d}-{rng.randint(1, 28):02d}"
            rows[i] = trip(
                i, 10 * b + 1, day, rng.choice([None, 1.25, 20.0, 33.33]), month=1 + i % 2,
                vendor_id=rng.choice([None, 1, 2]), fare_amount=rng.choice([None, Decimal("0.00"), Decimal("7.10")]),
                pu_location_id=rng.randint(1, 3), deleted=rng.random() < 0.1,
            )
        batches.append(list(rows.values()))
        last |= rows
    left = [r for r in last.values() if r["pickup_datetime"] is not None and not r["deleted"]]
    want = facts.fact_trips(trips(spark, left))
    for order in ([0, 1, 2, 3], [3, 1, 0, 2]):
        kept = DeltaFacts(loads.Warehouse(spark, scratch_dir(spark, "house")))
        for n, b in enumerate(order):
            kept.apply(trips(spark, batches[b]), n, "sent", "deleted")
            if n == 1:
                kept.fold("hourly")
        assert rows_of(kept.fact()) == rows_of(want)
        assert rows_of(kept.aggregate("daily")) == rows_of(facts.daily_agg(want))
        assert rows_of(kept.aggregate("hourly")) == rows_of(facts.hourly_agg(want))


def test_deltas_read_only_what_a_batch_touches(spark, house):
    kept = DeltaFacts(house)
    kept.apply(trips(spark, [trip(i, 1, "2024-01-05", month=1 + i % 6) for i in range(60)]), 0, "sent", "deleted")
    new = trips(spark, [trip(7, 2, "2024-02-05", month=2)])
    kept.apply(new, 1, "sent", "deleted")
    assert spark.read.parquet(f"{house.path('delta_replaced')}/batch_id=1").count() == 1
    deltas = spark.read.parquet(f"{house.path('delta_daily')}/batch_id=1")
    assert sorted((r.date_key, r.trips) for r in deltas.collect()) == [(20240105, -1), (20240205, 1)]
    arrived = spark.read.parquet(house.path("delta_trips")).filter("batch_id = 1")
    text = plan(kept._replaced(arrived, 1))
    assert "(source_month" in text.split("PartitionFilters")[1] and "GreaterThanOrEqual(trip_id,7)" in text
    assert kept.fold("daily") == 2  # January and February
    kept.apply(trips(spark, [trip(8, 3, "2024-02-07", month=3)]), 2, "sent", "deleted")
    assert kept.fold("daily") == 2 and kept.fold("hourly") == 2
    same_as_rebuilt(kept)


def test_a_batch_is_shuffled_once_and_large_months_are_dealt_out(spark, house, monkeypatch):
    sent = [trip(i, 1, f"2024-01-{i % 28 + 1:02d}", month=1 + (i % 10 == 0)) for i in range(60)]
    monkeypatch.setattr("tripstar.plans.deltas.ROWS_A_SLICE", 20)
    arrived = facts.fact_trips(trips(spark, sent), keep={"_sent": F.col("sent")}).withColumn("_dead", F.lit(False))
    text = plan(DeltaFacts._last_sent(arrived))
    assert text.count("Arguments: hashpartitioning(") == 1 and "REBALANCE" not in text
    monkeypatch.setattr("tripstar.plans.deltas.ROWS_A_SLICE", 5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    dealt = DeltaFacts._last_sent(arrived).filter("source_month = 1").select(F.spark_partition_id()).distinct().count()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert dealt > 1
    kept = DeltaFacts(house)
    kept.apply(trips(spark, sent), 0, "sent", "deleted")
    # sent again: as they are, and with a change that no aggregate counts
    kept.apply(trips(spark, [r | {"sent": 2, "extra": Decimal("1.00")} for r in sent]), 1, "sent", "deleted")
    same_as_rebuilt(kept)
    assert {r.extra for r in kept.fact().collect()} == {Decimal("1.00")} and kept.fact().count() == 60
    assert kept._read("delta_daily").filter("batch_id = 1").count() == 0


def test_a_batch_is_read_in_one_pass(spark, house, monkeypatch):
    seen, plain = [], DeltaFacts._last_sent
    monkeypatch.setattr(DeltaFacts, "_last_sent", staticmethod(lambda arrived: seen.append(plan(arrived)) or plain(arrived)))
    sent = [trip(1, 1, "2024-01-05"), trip(2, 1, None), trip(3, 1, "2024-01-06", deleted=True), trip(4, 1, "2024-01-07", deleted=None)]
    DeltaFacts(house).apply(trips(spark, sent), 0, "sent", "deleted")
    assert len(seen) == 1 and "Union" not in seen[0]
    rows = {r.trip_id: r for r in spark.read.parquet(house.path("delta_trips")).collect()}
    assert {i: r._dead for i, r in rows.items()} == {1: False, 2: True, 3: True, 4: False}
    for i in (2, 3):  # of a trip that is gone, its key and when it was sent
        assert {c for c, v in rows[i].asDict().items() if v is not None} == {"trip_id", "file_type", "source_year", "source_month", "batch_id", "_sent", "_dead"}


def test_many_files_are_streamed_in_as_many_batches_as_were_sent(spark, sf_dir, monkeypatch):
    folder, applied, plain = scratch_dir(spark, "many-files"), [], DeltaFacts.apply
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").filter("l_shipdate BETWEEN '1995-01-01' AND '1995-05-31'")
    lines.repartition(24).write.parquet(f"{folder}/lineitem.parquet")

    def apply(self, batch, *more):
        applied.append(more[0])
        return plain(self, batch, *more)

    monkeypatch.setattr(DeltaFacts, "apply", apply)
    found = upkeep.stream_delta_fact(spark, folder)
    files = spark.read.option("recursiveFileLookup", "true").parquet(upkeep._changing_trips(spark, folder)).inputFiles()
    assert len(files) > 30 and len(applied) <= 4
    want = facts.fact_trips(stored.trips(spark, folder)).filter("payment_type_id <> 3")
    assert rows_of(found) == rows_of(want.select(*found.columns))


def test_a_trip_without_an_id_fails_its_batch(spark, house):
    with pytest.raises(Exception, match="no trip_id"):
        DeltaFacts(house).apply(trips(spark, [trip(None, 1, "2024-01-05")]), 0, "sent", "deleted")


def test_streamed_deltas_go_on_after_a_restart(spark, house):
    source, checkpoint = scratch_dir(spark, "source"), scratch_dir(spark, "checkpoint")
    batches = [
        [trip(1, 1, "2024-01-05"), trip(2, 1, "2024-01-06")], [trip(1, 2, "2024-03-10")], [trip(2, 2, "2024-01-06", deleted=True)],
    ]
    for rows in batches:
        trips(spark, rows).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(trips(spark, []).schema).parquet(source)
        kept = jobs.keep_up(house, stream, checkpoint, "sent", "deleted")
        same_as_rebuilt(kept)
    assert [(r.date_key, r.total_trips) for r in kept.aggregate("daily").collect()] == [(20240310, 1)]


def test_a_moved_trip_is_counted_once_after_a_recompute(spark, house):
    source, checkpoint = scratch_dir(spark, "moved"), scratch_dir(spark, "checkpoint")
    for day in ("2024-01-10", "2024-03-10"):
        trips(spark, [trip(1, 1, day)]).drop("sent", "deleted").coalesce(1).write.mode("append").parquet(source)
        jobs.append_and_recompute(house, spark.readStream.schema(CONFORMED).parquet(source), checkpoint)
    assert [r.pickup_date_key for r in house.read("fact_trips").collect()] == [20240310]
    assert [(r.date_key, r.total_trips) for r in house.read("fact_trips_daily_agg").collect()] == [(20240310, 1)]


# distinct counts


def test_sets_hold_any_whole_number(spark):
    values = [0, 1, 32767, 32768, 32769, -1, -32768, -32769, 10**12, 10**12 + 40_000, None, 1]
    rows = spark.createDataFrame([("a" if i % 2 else "b", v) for i, v in enumerate(values)], "k string, v long")
    sets = rollups.member_sets(rows, ["k"], {"values": F.col("v")})
    each = {r.k: r.n for r in rollups.distinct_counts(sets, ["k"], {"values": "n"}).collect()}
    assert each == {k: len({v for i, v in enumerate(values) if v is not None and ("a" if i % 2 else "b") == k}) for k in "ab"}
    assert rollups.distinct_counts(sets, [], {"values": "n"}).first().n == 10


@pytest.mark.parametrize("build", ["monthly", "services", "routes", "vendors"])
def test_activity_reads_no_trips(spark, sf_dir, build):
    star, daily, sets = stored.star(spark, sf_dir), stored.daily(spark, sf_dir), stored.daily_sets(spark, sf_dir)
    frame = {
        "monthly": lambda: rollup_marts.monthly_actives(sets),
        "services": lambda: rollup_marts.service_activity(star, sets),
        "routes": lambda: rollup_marts.route_activity(star, daily),
        "vendors": lambda: rollup_marts.vendor_activity(star, daily),
    }[build]()
    text = plan(frame)
    scanned = [line for line in text.splitlines() if line.startswith("Location")]
    assert scanned and all("/daily" in line for line in scanned)
    assert "Expand" not in text and "SortMergeJoin" not in text


# quantiles


def test_classes_keep_order_and_width(spark):
    values = [*range(-700, 700), 2**31, 2**40 + 12345, -(2**33) - 7, 10**15 + 1]
    rows = spark.createDataFrame([(v,) for v in values], "v long")
    found = rows.select("v", rollups.value_class(F.col("v")).alias("c"), rollups.class_width(F.col("v")).alias("w")).orderBy("v").collect()
    assert all(a.c <= b.c for a, b in zip(found, found[1:], strict=False))
    for r in found:
        assert abs(r.c) <= abs(r.v) < abs(r.c) + r.w and r.w <= max(1, abs(r.v) >> rollups.PRECISION)
    middles = rows.select("v", rollups.middle(rollups.value_class(F.col("v"))).alias("m")).collect()
    assert all(abs(r.m - r.v) <= abs(r.v) / 2**rollups.PRECISION for r in middles)


def test_quantiles_of_merged_counts(spark):
    rng = random.Random(8)
    values = [(d, rng.choice(["a", "b"]), rng.choice([None, int(rng.lognormvariate(7, 1)), -rng.randint(0, 500)])) for d in range(400)]
    rows = spark.createDataFrame(values, "day int, k string, v long")
    counts = rollups.value_counts(rows, ["day", "k"], F.col("v"))
    for r in rollups.quantiles(counts, ["k"], [1, 50, 99, 100]).collect():
        own = sorted(v for _, k, v in values if k == r.k and v is not None)
        assert r.n == len(own)
        for p in (1, 50, 99, 100):
            exact, found = own[max(1, -(-len(own) * p // 100)) - 1], r[f"p{p}"]
            assert abs(found) <= abs(exact) <= abs(found) * (1 + 2**-rollups.PRECISION) + 1


# dedupe in state


def arrive(spark, path: str, rows: list[tuple]) -> None:
    frame = spark.createDataFrame(rows, "trip_id long, at timestamp, note string")
    frame.coalesce(1).write.mode("append").parquet(path)


def test_dedupe_inside_and_beyond_the_watermark(spark, house):
    path, checkpoint = scratch_dir(spark, "arrivals"), scratch_dir(spark, "checkpoint")
    day = lambda d, h=0: datetime(2024, 1, 1) + timedelta(days=d, hours=h)
    steps = [
        [(1, day(0), "first"), (1, day(0), "same batch"), (2, day(1), "first")],
        [(1, day(0), "inside"), (3, day(2), "first"), (None, day(2), "no id"), (None, day(2), "no id")],
        [(4, day(30), "first"), (3, day(2), "inside")],
        # a month later the state of the first days is gone
        [(1, day(0), "beyond"), (5, day(3), "late for the first time"), (5, day(3), "late twice"), (4, day(30), "inside"), (6, None, "no time")],
        [(5, day(3), "late again"), (2, day(1), "beyond"), (6, None, "again"), (7, day(60), "first"), (None, day(2), "no id")],
        [(4, day(30), "beyond by now"), (7, day(60), "inside"), (8, day(61), "first")],
    ]
    keys = ["trip_id", "at"]
    for rows in steps:
        arrive(spark, path, rows)
        stream = spark.readStream.schema("trip_id long, at timestamp, note string").parquet(path)
        jobs.append_once(house, stream, "once", keys, "at", checkpoint, "5 days")
    found = sorted(((r.trip_id, r.at) for r in house.read("once").collect()), key=str)
    assert found == sorted({(i, t) for rows in steps for i, t, _ in rows}, key=str)
    # timely rows were not compared with the table, late ones were
    parts = {(r.part, r.trip_id) for r in house.read("once").collect()}
    assert {("timely", 1), ("timely", 7), ("late", 5), ("late", 6)} <= parts
    # nothing more comes: running again changes nothing
    jobs.append_once(house, stream, "once", keys, "at", checkpoint, "5 days")
    assert house.read("once").count() == len(found)


def test_late_rows_and_held_keys_are_shuffled_once_each(spark):
    rows = spark.createDataFrame([(1, None, "a"), (1, None, "b"), (2, 5, "c"), (None, None, "d"), (3, 1, "e")], "i long, t long, note string")
    held = spark.createDataFrame([(None, None), (2, 5), (2, 5), (3, None)], "i long, t long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = jobs.first_of_new(rows, held, ["i", "t"])
        assert plan(new).split("\n\n")[0].count("Exchange") == 2
        found = {(r.i, r.t) for r in new.collect()}
        assert found == {(1, None), (3, 1)} and new.count() == 2 and new.columns == rows.columns
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
