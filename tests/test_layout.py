"""Ranks over ranges, bucketed tables, reconciliation by content."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tripstar.catalog import stored
from tripstar.operators import clustering, ledger, ranking, skew, upsert
from tripstar.operators.bucketed import BucketedTable
from tripstar.plans.load import Warehouse
from tripstar.session import scratch_dir


def plan(frame) -> str:
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ranks_with_ties_over_borders(spark):
    rng = random.Random(3)
    # half of all rows share a value, so it spans several ranges; NULLs and repeated rows as well
    values = [(rng.choice(["a", "b", None]), rng.choice([7, 7, 7, rng.randint(0, 20), None]), rng.randint(0, 3)) for _ in range(600)]
    rows = spark.createDataFrame(values, "g string, v int, w int")
    for by in ([], ["g"]):
        for order in ({"v": "desc"}, {"v": "asc", "w": "desc"}):
            found = ranking.ranked(rows, order, by, ranges=9)
            assert found.columns == ["g", "v", "w", *ranking.RANKS]
            sort = [F.col(c).asc_nulls_last() if d == "asc" else F.col(c).desc_nulls_last() for c, d in order.items()]
            window = Window.partitionBy(*by).orderBy(*sort)
            plain = rows.select("*", F.rank().over(window).alias("rank"), F.dense_rank().over(window).alias("dense_rank"))
            want = sorted(map(tuple, plain.collect()), key=str)
            assert sorted((tuple(r) for r in found.drop("row_number").collect()), key=str) == want
            numbers = [(r.g if by else "", r["row_number"]) for r in found.collect()]
            assert len(set(numbers)) == 600 and all(r["row_number"] >= r["rank"] for r in found.collect())
            sizes = {k: sum(1 for n in numbers if n[0] == k) for k, _ in numbers}
            assert all(1 <= n <= sizes[k] for k, n in numbers)
    assert ranking.ranked(rows.limit(0), {"v": "asc"}).count() == 0


def test_one_task_never_gets_all_rows(spark):
    rows = spark.range(20_000).select((F.col("id") % 2).alias("v"), "id")
    found = ranking.ranked(rows, {"v": "desc"}, ranges=16)
    text = plan(found)
    # what is gathered in one place is the table of ranges, after it was reduced
    assert text.count("Exchange SinglePartition") + text.count("SinglePartition, ENSURE") <= 1
    ranges = found.select(F.max("rank").alias("m"), F.max("row_number").alias("n")).first()
    assert (ranges.m, ranges.n) == (10_001, 20_000)


def exchanges(frame) -> int:
    return plan(frame).split("\n\n")[0].count("Exchange")


def test_bucketed_table_is_not_shuffled(spark, sf_dir, no_broadcast):
    fact = stored.fact(spark, sf_dir)
    table = BucketedTable(spark, ["trip_id"], 8).write(fact.filter("store_fwd_flag = 'Y'"))
    new = table.missing(fact)
    assert exchanges(new) == 1
    plain = fact.join(fact.filter("store_fwd_flag = 'Y'").select("trip_id").distinct(), "trip_id", "left_anti")
    assert new.count() == plain.count() > 0
    merged = table.merged(fact.limit(50), ["total_amount"])
    joined = plan(merged).split("\n\n")[0]
    assert "SortMergeJoin" in joined
    # one to reduce what comes in to a row per key, one to put it beside the buckets; none of the table
    scan = joined[joined.index("FullOuter") if "FullOuter" in joined else 0 :]
    assert scan.count("Scan parquet") == 2
    text = plan(merged)
    assert f"SelectedBucketsCount: {table.buckets} out of {table.buckets}" in text


def test_bucketed_merge_has_null_as_a_key(spark):
    schema = "a int, b string, v int, w string"
    old = spark.createDataFrame([(1, None, 10, "old"), (None, None, 20, "old"), (2, "x", 30, "old"), (3, "y", None, "old")], schema)
    new = spark.createDataFrame([(1, None, 11, "new"), (None, None, None, "new"), (None, "x", 5, "new"), (2, "x", 31, "new"), (2, "x", 32, "new")], schema)
    table = BucketedTable(spark, ["a", "b"], 4).write(old)
    after = table.merge(new, ["v"])
    want = upsert.upsert(old, new, ["a", "b"], ["v"])
    key = lambda r: str(tuple(r))
    assert sorted(after.read().collect(), key=key) == sorted(want.collect(), key=key)
    assert sorted(table.read().collect(), key=key) == sorted(old.collect(), key=key)
    assert [tuple(r) for r in table.missing(new).collect()] == [(None, "x", 5, "new")]


def test_reconciliation_finds_changes_behind_equal_counts(spark):
    schema = "m int, amount decimal(10,2), name string"
    rows = [(1, Decimal("5.00"), "a"), (1, Decimal("5.00"), "a"), (1, None, "b"), (2, Decimal("1.00"), None), (3, Decimal("2.00"), "c"), (None, None, None)]
    source = spark.createDataFrame(rows, schema)

    def verdicts(other: list[tuple]) -> dict:
        found = ledger.reconcile_contents(source, spark.createDataFrame(other, schema), ["m"], ["amount", "name"])
        return {r.m: (r.source_rows, r.stored_rows, r.same_content) for r in found.collect()}

    shuffled = rows[::-1]
    assert all(v[2] for v in verdicts(shuffled).values())
    changed = verdicts([(1, Decimal("5.00"), "a"), (1, Decimal("5.01"), "a"), *rows[2:]])
    assert changed[1] == (3, 3, False) and changed[2][2] and changed[None] == (1, 1, True)
    swapped = verdicts([rows[0], rows[2], rows[2], (2, None, "1.00"), rows[4], (4, None, None)])
    assert swapped == {1: (3, 3, False), 2: (1, 1, False), 3: (1, 1, True), 4: (0, 1, False), None: (1, 0, False)}


def test_house_reads_of_the_test_tables_keep_their_rows(spark, sf_dir):
    daily, hourly = stored.with_repeats(spark, sf_dir)
    assert daily.count() > stored.daily(spark, sf_dir).count() and hourly.count() > 0
    assert not Warehouse(spark, scratch_dir(spark, "none")).has("anything")


def row_groups(spark, path: str, column: str, low: int, high: int) -> tuple[int, int]:
    """Row groups whose statistics let a filter in, and all of them."""
    import glob

    import pyarrow.parquet as pq

    hit = total = 0
    for name in glob.glob(f"{path.removeprefix('file:')}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        for i in range(meta.num_row_groups):
            group = meta.row_group(i)
            stats = next(group.column(c).statistics for c in range(group.num_columns) if group.column(c).path_in_schema == column)
            total += 1
            hit += stats.min <= high and stats.max >= low
    return hit, total


def test_clustered_files_are_skipped_by_either_key(spark):
    rows = spark.range(40_000).select(
        (20240101 + F.col("id") % 28 + 100 * (F.col("id") % 12)).cast("int").alias("pickup_date_key"),
        # one place has two fifths of the trips
        F.when(F.rand(1) < 0.4, 7).otherwise(F.floor(F.rand(2) * 60)).cast("int").alias("pickup_location_id"),
        F.col("id"),
    )
    path, by_day = scratch_dir(spark, "clustered"), scratch_dir(spark, "by-day")
    keys = {"day": F.col("pickup_date_key"), "place": F.col("pickup_location_id")}
    clustering.write_clustered(rows, path, keys, 64)
    rows.repartitionByRange(64, "pickup_date_key", "pickup_location_id").write.parquet(by_day)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(40_000))
    month = row_groups(spark, path, "pickup_date_key", 20240501, 20240531)
    place = row_groups(spark, path, "pickup_location_id", 30, 30)
    assert month[1] >= 48 and month[0] <= month[1] / 3 and place[0] <= place[1] / 3
    # sorted by day first, a place is in most files
    assert row_groups(spark, by_day, "pickup_location_id", 30, 30)[0] > 2 * place[0]


def test_interleaved_bits(spark):
    rows = spark.createDataFrame([(a, b) for a in range(8) for b in range(8)], "a int, b int")
    for r in rows.select("a", "b", clustering.interleaved([F.col("a"), F.col("b")], 3).alias("z")).collect():
        want = int("".join(f"{x}{y}" for x, y in zip(f"{r.a:03b}", f"{r.b:03b}", strict=True)), 2)
        assert r.z == want
    same = clustering.range_number(F.col("a"), [1, 4, 6], 2)
    assert [r.n for r in rows.select("a", same.alias("n")).distinct().orderBy("a").collect()] == [0, 1, 1, 1, 2, 2, 3, 3]


def test_heavy_places_are_spread(spark, no_broadcast):
    trips = spark.range(30_000).select("id", F.when(F.col("id") % 5 < 2, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(400))).cast("int").alias("place"))
    trips = trips.withColumn("place", F.when(F.col("id") % 997 != 0, F.col("place")))
    table = spark.range(350).select(F.col("id").cast("int").alias("location_id"), F.concat(F.lit("z"), "id").alias("zone"))
    assert 7 in skew.heavy_keys(trips, "place") and len(skew.heavy_keys(trips, "place")) < 5
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = {}
        for name, joined in (
            ("salted", skew.salted_join(trips, table, "place", "location_id", "left", salts=32)),
            ("plain", trips.join(table, trips["place"] == table["location_id"], "left")),
        ):
            counts = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
            sizes[name] = counts[-1] / counts[len(counts) // 2]
            rows = sorted(map(tuple, joined.collect()))
            assert name == "salted" or rows == first
            first = rows
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sizes["salted"] <= 3 < sizes["plain"]
    inner = skew.salted_join(trips, table, "place", "location_id")
    assert inner.count() == sum(1 for r in first if r[3] is not None)


def test_log_opens_few_files_however_long(spark, monkeypatch):
    monkeypatch.setattr(ledger, "SNAPSHOT_EVERY", 4)
    log = ledger.Ledger(spark, scratch_dir(spark, "log"), ledger.RUN_LOG, ["year", "month", "fact_table_name"])
    assert log.read().count() == 0 and log.last_status(year=1) is None
    want = {}
    for i in range(18):
        status = f"s{i}"
        log.append(spark.createDataFrame([(2000 + i % 3, m, "fact_trips", status) for m in (1, 2)], "year int, month int, fact_table_name string, status string"))
        want |= {(2000 + i % 3, m): (status, i + 1) for m in (1, 2)}
        assert len(log.read().inputFiles()) <= 1 + ledger.SNAPSHOT_EVERY
    assert log.read().count() == 36
    assert {(r.year, r.month): (r.status, r.seq) for r in log.latest().collect()} == want
    assert log.last_status(year=2002, month=2) == "s17"
    # a snapshot that was not finished: its folder holds no file
    spark.createDataFrame([], ledger.RUN_LOG).limit(0).coalesce(1).write.parquet(f"{log.path}/unfinished")
    log.record(year=1, month=1, fact_table_name="x", status="late")
    assert log.read().count() == 37 and log.last_status(year=1) == "late"


def test_ten_thousand_entries(spark):
    log = ledger.Ledger(spark, scratch_dir(spark, "log"), ledger.RUN_LOG, ["year", "month", "fact_table_name"])
    many = spark.range(10_000).select(
        F.lit(2024).alias("year"), (F.col("id") % 12 + 1).cast("int").alias("month"), F.concat(F.lit("t"), F.col("id") % 7).alias("fact_table_name"),
        F.lit("loaded").alias("status"), F.col("id").alias("record_count"),
    )
    log.append(many)
    log.record(year=2024, month=1, fact_table_name="t0", status="failed")
    assert len(log.read().inputFiles()) == 2 and log.read().count() == 10_001
    found = {(r.month, r.fact_table_name): (r.status, r.record_count) for r in log.latest().collect()}
    assert len(found) == 84 and found[1, "t0"][0] == "failed" and found[2, "t1"] == ("loaded", 9997)


def test_stored_tables_are_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    from tripstar.catalog import stored

    monkeypatch.setattr(stored, "_paths", {})
    rows = stored._stored(spark, str(tmp_path), "parts", lambda: spark.range(0, 700, 1, 7))
    assert len(rows.inputFiles()) == 7 and rows.count() == 700


def test_a_fact_is_stored_without_the_trips(spark, monkeypatch):
    from tripstar.catalog import stored

    monkeypatch.setattr(stored, "_paths", {})
    stored.fact(spark, "/root/testdata/sf0.001")
    assert [name for _, _, name in stored._paths] == ["fact"]


def test_buckets_and_staged_files_grow_with_the_rows(spark, monkeypatch):
    from tripstar.catalog import operations, upkeep

    rows = spark.range(1000).selectExpr("id", "id AS day")
    monkeypatch.setattr(operations, "ROWS_A_FILE", 100)
    taken = []
    stream = operations._staged(spark, rows, ["day"], 3)

    def take(batch, _):
        taken.append((batch.count(), len(batch.inputFiles())))

    from tripstar.session import scratch_dir
    from tripstar.streaming import jobs

    jobs._run(stream, take, scratch_dir(spark, "checkpoint"))
    assert len(taken) == 3 and sum(n for n, _ in taken) == 1000
    made = []
    monkeypatch.setattr(upkeep, "ROWS_A_PART", 200)
    monkeypatch.setattr(upkeep.BucketedTable, "write", lambda self, rows: made.append(self.buckets) or self)
    monkeypatch.setattr(upkeep.BucketedTable, "missing", lambda self, rows: rows)
    fact = upkeep.fact_trips_incremental_bucketed(spark, "/root/testdata/sf0.001")
    assert made == [max(16, -(-fact.count() // 200))] and made[0] > 16
