"""Turning loosely typed source columns into typed ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for a missing value in source files.
NULL_TEXTS = ["NaN", "nan", "NAN", ""]


def null_if_sentinel(column: Column, dtype: T.DataType) -> Column:
    """NULL for the texts and the floating value that mean "missing"."""
    if isinstance(dtype, T.StringType):
        return F.when(~column.isin(NULL_TEXTS), column)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(column), column)
    return column


def timestamp_or_null(column: Column) -> Column:
    """Time in UTC without zone; NULL where the text is no timestamp."""
    return column.try_cast("timestamp").cast("timestamp_ntz")


def integer_or_null(column: Column) -> Column:
    """Whole number, rounding a fraction; NULL where the text is no number."""
    return F.round(column.cast("string").try_cast("decimal(20,6)"), 0).try_cast("int")


def number_or_null(column: Column) -> Column:
    """Double; NULL where the text is no number or not a finite one."""
    value = column.try_cast("double")
    return F.when(~F.isnan(value), value)


def decimal_or_null(column: Column, precision: int, scale: int) -> Column:
    return column.try_cast(T.DecimalType(precision, scale))


def first_character(column: Column) -> Column:
    return F.substring(column, 1, 1)
