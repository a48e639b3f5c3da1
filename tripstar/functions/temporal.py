"""Smart keys, durations and month arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(ts: Column) -> Column:
    """``YYYYMMDD`` as an integer, built without formatting a string."""
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def time_key(ts: Column) -> Column:
    """``HHMM`` as an integer."""
    return F.hour(ts) * 100 + F.minute(ts)


def hour_of_key(key: Column) -> Column:
    """Hour of an ``HHMM`` key."""
    return F.floor(key / 100).cast("int")


def hour_bucket(key: Column) -> Column:
    """``HHMM`` key rounded down to its hour."""
    return hour_of_key(key) * 100


def month_of_key(key: Column) -> Column:
    """``YYYYMM`` of a ``YYYYMMDD`` key."""
    return F.floor(key / 100).cast("int")


def minutes_crossed(start: Column, end: Column) -> Column:
    """Number of minute boundaries between two times; negative if end is earlier.

    Built from the same parts as the keys, so they are computed once per row.
    """
    minute_of_day = lambda ts: F.hour(ts) * 60 + F.minute(ts)
    return F.datediff(end, start) * 1440 + minute_of_day(end) - minute_of_day(start)


def elapsed_micros(start: Column, end: Column) -> Column:
    """Elapsed microseconds, as whole microseconds so that sums stay exact."""
    micros = lambda ts: F.unix_micros(ts.cast("timestamp"))
    return micros(end) - micros(start)


def target_month(run_date: Column) -> Column:
    """First day of the month one year before the month of a run."""
    return F.add_months(F.trunc(run_date, "month"), -12)


def month_range(year: int, month: int) -> tuple[int, int]:
    """Bounds of a month on a ``YYYYMMDD`` key."""
    first = year * 10000 + month * 100
    return first + 1, first + 31


def month_ranges(months: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Bounds of some months on a ``YYYYMMDD`` key, months that follow each other in one."""
    runs: list[tuple[int, int]] = []
    last = None
    for month in sorted(set(months)):
        first, end = month_range(*month)
        if last is not None and previous_month(*month) == last:
            first = runs.pop()[0]
        runs.append((first, end))
        last = month
    return runs


def previous_month(year: int, month: int) -> tuple[int, int]:
    return (year - 1, 12) if month == 1 else (year, month - 1)
