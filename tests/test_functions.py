"""Column expressions on hand-written values."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripstar.functions import cleaning, exact, labels, temporal


def values(spark, rows, schema, column):
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema)
    return [r[0] for r in frame.orderBy("i").select(column).collect()]


def half_away(x: Fraction) -> float:
    cents = abs(x) * 100
    whole = int(cents + Fraction(1, 2))
    return (-whole if x < 0 else whole) / 100.0


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(-10**9, 10**9), st.integers(-10**6, 10**6)), min_size=1, max_size=50
    )
)
def test_percent_is_exact(spark, pairs):
    got = values(spark, pairs, "p bigint, w bigint", exact.percent(F.col("p"), F.col("w")))
    want = [None if w == 0 else half_away(Fraction(100 * p, w)) for p, w in pairs]
    assert got == want


def test_percent_ties_and_growth(spark):
    rows = [(1, 32), (-1, 32), (201, 20000)]
    got = values(spark, rows, "p bigint, w bigint", exact.percent(F.col("p"), F.col("w")))
    assert got == [3.13, -3.13, 1.01]  # 3.125, -3.125 and 1.005 round away from zero
    rows = [(Decimal("150.00"), Decimal("100.00")), (Decimal("5.00"), Decimal("0.00")),
            (Decimal("5.00"), None)]
    got = values(spark, rows, "n decimal(20,2), b decimal(20,2)",
                 exact.growth(F.col("n"), F.col("b")))
    assert got == [50.0, None, None]


def test_mean2_keeps_exact_halves(spark):
    rows = [(Decimal("38.05"), 2), (Decimal("-38.05"), 2), (None, 0)]
    got = values(spark, rows, "s decimal(20,2), n bigint", exact.mean2(F.col("s"), F.col("n")))
    assert got == [19.03, -19.03, None]


def test_ratio2_rounds_half_away(spark):
    rows = [(1005, 1000), (-1005, 1000), (2675, 1000)]
    got = values(spark, rows, "n bigint, d bigint", exact.ratio2(F.col("n"), F.col("d")))
    assert got == [0.01, -0.01, 0.03]


def test_minutes_cross_boundaries_not_elapsed(spark):
    t = datetime
    rows = [
        (t(2024, 1, 1, 10, 0, 59), t(2024, 1, 1, 10, 1, 0)),
        (t(2024, 1, 1, 10, 0, 0), t(2024, 1, 1, 10, 0, 59)),
        (t(2024, 1, 1, 23, 59, 59), t(2024, 1, 2, 0, 0, 0)),
        (t(2024, 1, 1, 10, 5, 0), t(2024, 1, 1, 10, 0, 30)),
        (t(2024, 1, 1, 10, 5, 0), None),
    ]
    got = values(spark, rows, "s timestamp_ntz, e timestamp_ntz",
                 temporal.minutes_crossed(F.col("s"), F.col("e")))
    assert got == [1, 0, 1, -5, None]


def test_keys_and_months(spark):
    rows = [(datetime(2024, 2, 9, 7, 5),)]
    ts = F.col("t")
    assert values(spark, rows, "t timestamp_ntz", temporal.date_key(ts)) == [20240209]
    assert values(spark, rows, "t timestamp_ntz", temporal.time_key(ts)) == [705]
    assert values(spark, rows, "t timestamp_ntz",
                  temporal.hour_bucket(temporal.time_key(ts))) == [700]
    assert temporal.month_range(2024, 7) == (20240701, 20240731)
    assert temporal.previous_month(2024, 1) == (2023, 12)
    got = values(spark, [(date(2024, 2, 29),)], "d date", temporal.target_month(F.col("d")))
    assert got == [date(2023, 2, 1)]


@pytest.mark.parametrize(
    "text, whole, number, time",
    [
        ("5", 5, 5.0, None),
        ("5.0", 5, 5.0, None),
        ("2.5", 3, 2.5, None),
        ("n/a", None, None, None),
        ("NaN", None, None, None),
        ("", None, None, None),
        (None, None, None, None),
        ("2024-03-01 10:00:00", None, None, datetime(2024, 3, 1, 10)),
        ("2024-03-01T10:00:00+02:00", None, None, datetime(2024, 3, 1, 8)),
    ],
)
def test_tolerant_casts(spark, text, whole, number, time):
    frame = spark.createDataFrame([(text,)], "t string")
    c = F.col("t")
    row = frame.select(
        cleaning.integer_or_null(c).alias("i"), cleaning.number_or_null(c).alias("d")
    ).first()
    assert (row.i, row.d) == (whole, number)
    if time is not None:
        assert frame.select(cleaning.timestamp_or_null(c)).first()[0] == time


def test_labels(spark):
    assert values(spark, [("Mon",), ("Monday",), ("x",)], "d string",
                  labels.full_day_name(F.col("d"))) == ["Monday", "Monday", "x"]
    assert values(spark, [("Sep",), ("September",), ("x",)], "d string",
                  labels.month_number(F.col("d"))) == [9, 9, 0]
    assert values(spark, [(80.0,), (79.9,), (49.9,)], "v double",
                  labels.demand_band(F.col("v"))) == ["Peak Hours", "High Demand", "Low Demand"]
    assert values(spark, [(10000,), (5000,), (1,)], "v int", labels.traffic_band(F.col("v"))) == [
        "High Traffic", "Medium Traffic", "Low Traffic"]
    assert values(spark, [("Premium Car",), ("Regular",), ("Taxi",)], "c string",
                  labels.service_class(F.col("c"))) == [
        "premium-service", "standard-service", "economy-service"]
    assert values(spark, [(1,), (3,), (7,)], "r int", labels.rank_label(F.col("r"))) == [
        "gold", "bronze", "#7"]


def test_months_in_a_row_are_one_range():
    months = [(1997, 11), (1998, 1), (1997, 12), (1998, 1), (1998, 3), (1995, 6)]
    assert temporal.month_ranges(months) == [(19950601, 19950631), (19971101, 19980131), (19980301, 19980331)]
    assert temporal.month_ranges([]) == []
