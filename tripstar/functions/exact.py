"""Arithmetic that does not depend on row order or on an intermediate scale."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(28,2)"


def mean(total: Column, n: Column) -> Column:
    """Average from a sum and a count of non-null values; NULL when there are none."""
    return total.cast("double") / F.nullif(n.cast("double"), F.lit(0.0))


def mean2(total: Column, n: Column, unit: int = 1) -> Column:
    """Average to two places, half away from zero, of a total counted in ``1/unit``.

    Taken on whole hundredths, so an exact half is never missed; NULL without values.
    """
    base = F.nullif(n, F.lit(0)).cast("decimal(18,0)") * F.lit(unit)
    wide = total.cast("decimal(30,2)")
    hundredths = F.call_function("div", F.abs(wide) * F.lit(200) + base, base * F.lit(2))
    return (F.signum(wide).cast("int") * hundredths).cast("double") / F.lit(100.0)


_digits: ContextVar[int | None] = ContextVar("digits", default=None)


@contextmanager
def comparable(digits: int = 6) -> Iterator[None]:
    """Columns built inside are cut below the noise that summation order adds to floating averages.

    For results that are compared with those of another engine; others keep all their digits.
    """
    token = _digits.set(digits)
    try:
        yield
    finally:
        _digits.reset(token)


def stable(value: Column) -> Column:
    """A floating average, whose last digits depend on the order of summation."""
    digits = _digits.get()
    return value if digits is None else F.round(value, digits)


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` to two places, half away from zero; NULL if whole is 0.

    Both arguments must be integers or decimals with at most two places. The
    quotient is taken on whole hundredths, so a tie is never lost to rounding of
    an intermediate result.
    """
    p, w = part.cast(_WIDE), F.nullif(whole.cast(_WIDE), F.lit(0).cast(_WIDE))
    hundredths = F.call_function(
        "div", F.abs(p) * F.lit(20000) + F.abs(w), F.abs(w) * F.lit(2)
    )
    sign = F.when((p < 0) != (w < 0), F.lit(-1)).otherwise(F.lit(1))
    return (sign * hundredths).cast("double") / F.lit(100.0)


def growth(now: Column, before: Column) -> Column:
    """Percentage change from ``before`` to ``now``; NULL without a base."""
    return percent(now.cast(_WIDE) - before.cast(_WIDE), before)


def hundredths(amount: Column) -> Column:
    """A two-place decimal as whole hundredths (exact below 2**53)."""
    return F.rint(amount.cast("double") * 100).cast("bigint")


def ratio2(numerator: Column, denominator: Column) -> Column:
    """Quotient of whole numbers in hundredths, half away from zero, as a double.

    Stays in 64-bit arithmetic, so it is cheap enough for every row. The
    denominator must be positive.
    """
    halves = F.call_function(
        "div", F.abs(numerator) * 2 + denominator, denominator.cast("bigint") * 2
    )
    return (F.signum(numerator.cast("double")) * halves) / 100.0
