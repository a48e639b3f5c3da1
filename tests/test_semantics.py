"""Facts, marts and analyses on a few hand-written trips."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tripstar.operators import audits, facts, normalize, summaries
from tripstar.plans import airports, headlines, heatmap, marts, routes, trends
from tripstar.schemas import CONFORMED
from tripstar.sources import dimensions


def trip(**given):
    row = {field.name: None for field in CONFORMED.fields}
    row.update(file_type="yellow", year=2024, month=1, trip_id=1,
               pickup_datetime=datetime(2024, 1, 10, 8, 0))
    row.update(given)
    for name in ("fare_amount", "tip_amount", "total_amount", "trip_distance", "airport_fee",
                 "mta_tax", "improvement_surcharge", "congestion_surcharge"):
        if row[name] is not None:
            row[name] = Decimal(str(row[name]))
    return tuple(row.values())


def star(spark, *trips, **options):
    fact = facts.fact_trips(spark.createDataFrame(list(trips), CONFORMED))
    return dimensions.build_star(spark, fact, date(2023, 1, 1), date(2025, 12, 31), **options)


def test_unknown_members_are_defaulted(spark):
    row = star(spark, trip()).fact_trips.first()
    assert (row.pickup_location_id, row.dropoff_location_id, row.vendor_id) == (0, 0, 0)
    assert (row.payment_type_id, row.ratecode_id, row.trip_type_id) == (0, 1, 0)
    assert row.store_fwd_flag == " "
    assert (row.pickup_date_key, row.pickup_time_key, row.dropoff_date_key) == (20240110, 800, None)
    assert row.trip_duration_minutes is None


def test_trips_without_pickup_are_dropped(spark):
    assert star(spark, trip(pickup_datetime=None)).fact_trips.count() == 0


def test_derived_measures_guard_zero_and_null(spark):
    tables = star(
        spark,
        trip(trip_id=1, fare_amount=8, tip_amount=1, total_amount=10, trip_distance=4,
             dropoff_datetime=datetime(2024, 1, 10, 8, 30)),
        trip(trip_id=2, fare_amount=0, tip_amount=1, total_amount=10, trip_distance=0),
        trip(trip_id=3, fare_amount=8),
    )
    rows = {r.trip_id: r for r in facts.derived_measures(tables.fact_trips).collect()}
    found = lambda i: (rows[i].tip_percentage, rows[i].avg_speed_mph,
                       rows[i].revenue_per_mile)
    assert found(1) == (12.5, 8.0, 2.5)
    assert found(2) == (0.0, 0.0, 0.0)
    assert found(3) == (None, 0.0, 0.0)


def test_mean_of_ratios_differs_from_ratio_of_sums(spark):
    tables = star(
        spark,
        trip(trip_id=1, fare_amount=10, tip_amount=5, vendor_id=1),
        trip(trip_id=2, fare_amount=90, tip_amount=0, vendor_id=1),
        trip(trip_id=3, vendor_id=1),
    )
    row = marts.vendor_performance(tables).first()
    assert row.avg_tip_percentage == pytest.approx(50 / 3, abs=1e-6)
    assert facts.daily_agg(tables.fact_trips).first().avg_tip_percentage == 5.0


def test_surcharge_total_skips_trips_lacking_a_part(spark):
    parts = dict(mta_tax=1, improvement_surcharge=1, congestion_surcharge=1)
    rows = spark.createDataFrame(
        [trip(**parts, airport_fee=1), trip(**parts)], CONFORMED
    )
    assert summaries.fare_summary(rows).first().total_surcharges == Decimal("4.00")
    only = spark.createDataFrame([trip(**parts)], CONFORMED)
    assert summaries.fare_summary(only).first().total_surcharges is None


def test_both_ends_airport_counts_as_from(spark):
    tables = star(
        spark,
        trip(trip_id=1, pu_location_id=1, do_location_id=1, total_amount=5),
        trip(trip_id=2, pu_location_id=4, do_location_id=1, total_amount=7),
        trip(trip_id=3, pu_location_id=4, do_location_id=2, total_amount=7),
    )
    traffic = marts.airport_traffic(tables)
    assert {(r.trip_type, r.trip_count) for r in traffic.collect()} == {
        ("From Airport", 1), ("To Airport", 1)}
    row = airports.headline(traffic).first()
    assert (row.from_pct, row.to_pct, row.airports_served) == (50.0, 50.0, 1)


def test_orphan_places_leave_inner_marts_but_stay_in_the_wide_one(spark):
    tables = star(spark, trip(pu_location_id=265, do_location_id=4))
    assert marts.location_performance(tables).count() == 0
    wide = marts.trip_analytics(tables).first()
    assert wide.pickup_location_id is None and wide.dropoff_zone == "Manhattan"
    orphans = audits.fk_orphans(tables, "f", tables.fact_trips, audits.FACT_REFERENCES)
    assert {r.column_name for r in orphans.filter("orphan_rows > 0").collect()} == {
        "pickup_location_id"}


def test_supplied_locations_replace_the_short_list(spark):
    places = spark.createDataFrame(
        [(265, "Far", "Outside", "x", "x", False, False),
         (4, "Manhattan", "Manhattan", "x", "x", False, True)],
        dimensions.SCHEMAS["dim_location"],
    )
    tables = star(spark, trip(pu_location_id=265, do_location_id=4), dim_location=places)
    assert marts.location_performance(tables).first().pickup_zone == "Far"
    assert "dim_location" in tables.supplied


def test_month_gap_compares_with_the_month_present(spark):
    tables = star(
        spark,
        trip(trip_id=1, pickup_datetime=datetime(2024, 1, 5), total_amount=10),
        trip(trip_id=2, pickup_datetime=datetime(2024, 4, 5), total_amount=10),
        trip(trip_id=3, pickup_datetime=datetime(2024, 4, 6), total_amount=15),
    )
    rows = marts.monthly_trends(tables).collect()
    assert [(r.month, r.prev_month_trips, r.trips_mom_growth, r.revenue_mom_growth)
            for r in rows] == [(1, None, None, None), (4, 1, 100.0, 150.0)]
    found = {r.insight: r.month_name for r in trends.extremes(marts.monthly_trends(tables)).collect()}
    assert found["best_trip_growth"] == found["worst_trip_growth"] == "Apr"
    assert trends.summary(marts.monthly_trends(tables)).first().avg_trip_growth == 100.0


def test_rank_ties_share_a_rank_and_minimum_applies_first(spark):
    def many(start, n, pu, do, amount):
        return [trip(trip_id=start + i, pu_location_id=pu, do_location_id=do, total_amount=amount)
                for i in range(n)]

    tables = star(spark, *many(0, 3, 2, 3, 10), *many(10, 3, 3, 4, 20), *many(20, 2, 4, 5, 90))
    rows = marts.top_routes(tables, min_trips=2).collect()
    assert [(r.pickup_zone, r.route_rank_by_volume, r.route_rank_by_revenue) for r in rows] == [
        ("Brooklyn", 1, 1), ("Queens", 1, 2)]
    loose = marts.top_routes(tables, min_trips=0)
    lead = {r.insight: r.label for r in routes.insights(loose).collect()}
    assert lead["most_profitable_route"] == "Manhattan → Bronx"
    assert [r.value for r in routes.top_n_by_metric(loose, "total_revenue", 2).collect()] == [
        180.0, 60.0]


def test_kpis_of_an_empty_month(spark):
    tables = star(spark, trip(total_amount=10))
    row = marts.executive_kpis(tables, date(2024, 2, 1)).first()
    assert (row.total_trips, row.total_revenue, row.trips_growth_pct) == (0, None, -100.0)
    row = marts.executive_kpis(tables, date(2024, 9, 1)).first()
    assert (row.total_trips, row.trips_growth_pct) == (0, None)
    ratios = headlines.executive_ratios(marts.executive_kpis(tables, date(2024, 2, 1))).first()
    assert (ratios.passengers_per_trip, ratios.previous_trips) == (0.0, None)


def test_kpis_in_january_look_back_over_the_year(spark):
    tables = star(spark, trip(trip_id=1, pickup_datetime=datetime(2023, 12, 31)),
                  trip(trip_id=2, pickup_datetime=datetime(2024, 1, 1)),
                  trip(trip_id=3, pickup_datetime=datetime(2024, 1, 2)))
    assert marts.executive_kpis(tables, date(2024, 1, 31)).first().trips_growth_pct == 100.0


def test_heatmap_properties(spark):
    trips = [trip(trip_id=i, pickup_datetime=datetime(2024, 1, 1 + i % 7, i % 24)) for i in range(50)]
    demand = marts.hourly_demand_heatmap(star(spark, *trips))
    assert demand.agg(F.max("demand_intensity")).first()[0] == 100.0
    pivot = heatmap.overall_pivot(demand).collect()
    assert [r.day_name for r in pivot] == heatmap.WEEK
    one_day = demand.filter(F.col("day_name") == "Mon")
    assert [r.day_name for r in heatmap.overall_pivot(one_day).collect()] == heatmap.WEEK


def test_market_shares_add_up(spark):
    trips = [trip(trip_id=i, vendor_id=1 + i % 3) for i in range(10)]
    shares = marts.vendor_performance(star(spark, *trips))
    assert shares.agg(F.sum("market_share_pct")).first()[0] == pytest.approx(100, abs=0.05)


def test_calendar_and_clock(spark):
    days = dimensions.calendar(spark)
    assert days.count() == 8035
    row = days.filter(F.col("date_key") == 20240106).first()
    assert (row.day_of_week, row.day_name, row.is_weekend, row.week_of_year) == (7, "Sat", True, 1)
    clock = {r.time_key: r for r in dimensions.clock(spark).collect()}
    assert len(clock) == 1440
    assert (clock[459].time_period, clock[500].time_period, clock[2100].time_period) == (
        "Night", "Early Morning", "Night")
    assert clock[1759].business_hours_flag and not clock[1800].business_hours_flag
    assert clock[959].rush_hour_flag and not clock[1000].rush_hour_flag


def test_rollups_agree_with_detail(spark, sf_dir):
    from tripstar.catalog import stored

    fact = stored.fact(spark, sf_dir)
    daily, hourly = facts.daily_agg(fact), facts.hourly_agg(fact)
    n = fact.count()
    assert daily.agg(F.sum("total_trips")).first()[0] == n
    assert hourly.agg(F.sum("total_trips")).first()[0] == n
    assert facts.heatmap_from_hourly(hourly).agg(F.sum("trip_count")).first()[0] == n


def test_filter_applies_only_to_present_columns(spark):
    rows = spark.createDataFrame([(5.0,), (-1.0,), (None,)], "fare_amount double")
    assert normalize.filter_invalid_trips(rows).count() == 1


def test_strict_and_tolerant_services(spark):
    raw = spark.createDataFrame(
        [("1", "2024-01-01 00:00:00", "x")],
        "VENDORID string, lpep_pickup_datetime string, payment_type string",
    )
    good, bad = normalize.split_rejects(raw, "green")
    assert (good.count(), bad.count()) == (1, 0)
    row = normalize.conform(good, "green").first()
    assert (row.vendor_id, row.payment_type) == (1, None)

    yellow = raw.withColumnRenamed("lpep_pickup_datetime", "tpep_pickup_datetime")
    good, bad = normalize.split_rejects(yellow, "yellow")
    assert good.count() == 0 and bad.first().bad_columns == "payment_type"
    with pytest.raises(Exception, match="does not convert"):
        normalize.conform(yellow, "yellow").collect()


def test_amounts_that_do_not_fit_are_rejected(spark):
    raw = spark.createDataFrame(
        [(1, "2024-01-01", 99999999.99), (2, "2024-01-01", 99999999.995),
         (3, "2024-01-01", float("nan")), (4, "2024-01-01", None), (5, "2024-01-01", -1e9)],
        "VendorID int, tpep_pickup_datetime string, total_amount double",
    )
    good, bad = normalize.split_rejects(raw, "yellow")
    assert sorted(r.VendorID for r in bad.collect()) == [2, 5]
    kept = normalize.conform(good, "yellow", strict=False).collect()
    assert sorted((r.vendor_id, r.total_amount) for r in kept if r.total_amount) == [
        (1, Decimal("99999999.99"))]


def test_views_are_registered(spark):
    names = marts.create_views(star(spark, trip()), date(2024, 1, 1), prefix="t_")
    assert len(names) == 13
    assert spark.sql("SELECT count(*) AS n FROM t_trip_analytics").first().n == 1
