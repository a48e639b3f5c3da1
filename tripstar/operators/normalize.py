"""Conforming raw rows of any service to one schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstar.functions import cleaning
from tripstar.schemas import (
    CANONICAL,
    COLUMN_MAP,
    CONFORMED,
    LINEAGE,
    ONE_CHARACTER,
    TOLERANT_INTEGERS,
)

_TARGET = {field.name: field.dataType for field in CONFORMED.fields if field.name not in LINEAGE}


# ---------------------------------------------------------------------------
# Steps on frames that already carry table column names
# ---------------------------------------------------------------------------
def parse_timestamps(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Parse the named columns that exist; texts that are no time become NULL."""
    parsed = {c: cleaning.timestamp_or_null(rows[c]) for c in columns if c in rows.columns}
    return rows.withColumns(parsed) if parsed else rows


def correct_numeric_types(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Make the named columns that exist doubles; texts that are no number become NULL."""
    typed = {c: cleaning.number_or_null(rows[c]) for c in columns if c in rows.columns}
    return rows.withColumns(typed) if typed else rows


def filter_invalid_trips(rows: DataFrame) -> DataFrame:
    """Keep plausible trips; each test applies only where its column exists."""
    tests = {
        "fare_amount": lambda c: c >= 0,
        "trip_distance": lambda c: c > 0,
        "passenger_count": lambda c: c > 0,
    }
    for name, test in tests.items():
        if name in rows.columns:
            rows = rows.filter(test(F.col(name)))
    return rows


def null_sentinels(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Replace the values that mean "missing" by NULL."""
    types = {field.name: field.dataType for field in rows.schema.fields}
    cleaned = {c: cleaning.null_if_sentinel(F.col(c), types[c]) for c in columns or types}
    return rows.withColumns(cleaned)


def align(raw: DataFrame, service: str) -> DataFrame:
    """Rename to table columns, pad missing ones with NULL, order, drop the rest."""
    names = {source.lower(): target for source, target in COLUMN_MAP[service].items()}
    renamed = {names.get(column.lower(), column): column for column in raw.columns}
    return raw.select(
        *[
            raw[renamed[target]].alias(target)
            if target in renamed
            else F.lit(None).cast(dtype).alias(target)
            for target, dtype in CANONICAL.items()
        ]
    )


def canonical(aligned: DataFrame) -> DataFrame:
    """Aligned rows with the types of the canonical table, so services can be united."""
    rows = null_sentinels(aligned)

    def typed(name: str, dtype: T.DataType) -> Column:
        if isinstance(dtype, T.TimestampNTZType):
            return cleaning.timestamp_or_null(F.col(name))
        if isinstance(dtype, T.DoubleType):
            return cleaning.number_or_null(F.col(name))
        return F.col(name).try_cast(dtype)

    return rows.select(*[typed(name, dtype).alias(name) for name, dtype in CANONICAL.items()])


# ---------------------------------------------------------------------------
# Raw rows to the conformed trip table
# ---------------------------------------------------------------------------
def split_rejects(raw: DataFrame, service: str) -> tuple[DataFrame, DataFrame]:
    """Rows that convert, and rows to set aside with the names of their bad columns.

    Only columns the service reads strictly can reject a row. Both results are
    plain filters over the same scan.
    """
    bad = F.array_compact(
        F.array(*[F.when(test, F.lit(name)) for name, test in _failures(raw, service)])
    )
    good = raw.filter(~reduce(lambda a, b: a | b, [t for _, t in _failures(raw, service)]))
    rejected = raw.withColumn("bad_columns", F.array_join(bad, ",")).filter(
        F.col("bad_columns") != ""
    )
    return good, rejected


def conform(
    raw: DataFrame,
    service: str,
    processed_at: Column | None = None,
    keep_without_pickup: bool = False,
    strict: bool = True,
) -> DataFrame:
    """Raw rows of one service as conformed trips.

    ``year``, ``month`` and ``trip_id`` are taken from the rows where a scan added
    them. Rows without a readable pickup time are dropped. A value the service
    reads strictly and that does not convert fails the job; rows that went through
    :func:`split_rejects` hold no such value and need no second test (``strict=False``).
    """
    trips = raw.select(*_conformed_columns(raw, service, processed_at, strict))
    return trips if keep_without_pickup else trips.filter(F.col("pickup_datetime").isNotNull())


def sort_out(raw: DataFrame, service: str, processed_at: Column | None = None) -> DataFrame:
    """Conformed rows with their ``outcome``, from one pass over the raw rows.

    ``good`` rows go to the trip table, ``rejected`` ones are set aside with the names
    of their bad columns and the raw row, ``dropped`` ones have no readable pickup time.
    """
    names = F.array(*[F.when(test, F.lit(name)) for name, test in _failures(raw, service)])
    bad = F.array_join(F.array_compact(names), ",")
    kept = F.struct(*[c for c in raw.columns if c not in ("year", "month")])
    rows = raw.select(
        *_conformed_columns(raw, service, processed_at, strict=False),
        F.nullif(bad, F.lit("")).alias("bad_columns"),
        F.when(bad != "", F.to_json(kept)).alias("row"),
    )
    outcome = F.when(F.col("bad_columns").isNotNull(), "rejected").when(
        F.col("pickup_datetime").isNotNull(), "good"
    )
    return rows.withColumn("outcome", outcome.otherwise("dropped"))


def _conformed_columns(
    raw: DataFrame, service: str, processed_at: Column | None, strict: bool
) -> list[Column]:
    values = {name: value for name, value, _ in _converted(raw, service, strict)}
    columns = []
    for field in CONFORMED.fields:
        if field.name == "file_type":
            value = F.lit(service)
        elif field.name == "processed_at":
            value = F.lit(None) if processed_at is None else processed_at
        elif field.name in LINEAGE:
            value = raw[field.name] if field.name in raw.columns else F.lit(None)
        else:
            value = values.get(field.name, F.lit(None))
        columns.append(value.cast(field.dataType).alias(field.name))
    return columns


def union_services(parts: list[DataFrame]) -> DataFrame:
    """One trip table from the conformed rows of several services."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _converted(
    raw: DataFrame, service: str, strict: bool
) -> list[tuple[str, Column, Column | None]]:
    """Per mapped column: target name, converted value, and the test that it failed."""
    types = {field.name.lower(): field for field in raw.schema.fields}
    out = []
    for source, target in COLUMN_MAP[service].items():
        dtype = _TARGET.get(target)
        field = types.get(source.lower())
        if dtype is None or field is None:
            continue
        present = cleaning.null_if_sentinel(raw[field.name], field.dataType)
        value = _convert(present, field.dataType, target, dtype)
        tolerant = isinstance(dtype, (T.TimestampNTZType, T.StringType)) or (
            target in TOLERANT_INTEGERS[service]
        )
        failed = None if tolerant else _failed(present, field.dataType, value, dtype)
        if strict and failed is not None:
            message = F.concat(F.lit(f"{source} does not convert: "), present.cast("string"))
            value = F.when(failed, F.raise_error(message)).otherwise(value)
        out.append((target, value, failed))
    return out


def _failed(present: Column, source: T.DataType, value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.DecimalType) and isinstance(source, (T.FloatType, T.DoubleType)):
        # a float fails only by its size, which is cheaper to test than to convert
        limit = 10.0 ** (dtype.precision - dtype.scale) - 0.5 * 10.0**-dtype.scale
        return present.isNotNull() & (F.abs(present) >= limit)
    return present.isNotNull() & value.isNull()


def _failures(raw: DataFrame, service: str) -> list[tuple[str, Column]]:
    converted = _converted(raw, service, strict=False)
    # for-hire files have no strictly read column, so nothing can fail
    return [(n, f) for n, _, f in converted if f is not None] or [("none", F.lit(False))]


def _convert(value: Column, source: T.DataType, target: str, dtype: T.DataType) -> Column:
    if source == dtype:
        return value
    if isinstance(dtype, T.TimestampNTZType):
        return cleaning.timestamp_or_null(value)
    if isinstance(dtype, T.IntegerType):
        whole = isinstance(source, (T.IntegralType,))
        return value.try_cast("int") if whole else cleaning.integer_or_null(value)
    if isinstance(dtype, T.DecimalType):
        return cleaning.decimal_or_null(value, dtype.precision, dtype.scale)
    text = value.cast("string")
    return cleaning.first_character(text) if target in ONE_CHARACTER else text
