"""Finding and reading monthly raw Parquet sources.

A monthly source is a file or a folder of files whose path contains
``{service}_tripdata_{yyyy}-{mm}``. Column names are matched whatever their
case; columns a source lacks are read as NULL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstar.schemas import COLUMN_MAP, HIGH_VOLUME

Months = list[tuple[int, int]]

_SOURCE_SQL = r"([A-Za-z]+)_tripdata_(\d{4})-(\d{2})"

# A trip id packs month and service, file number and row position into 63 bits.
FILE_BITS, ROW_BITS = 22, 28
# File numbers are broadcast to a scan up to this many files, and joined beyond it.
BROADCAST_FILES = 100_000


def source_glob(service: str = "*", year: int | None = None, month: int | None = None) -> str:
    """Path pattern of the sources of one service, year or month."""
    # without a service the pattern must not swallow the text before the name
    prefix = "*_tripdata_" if service == "*" else f"*{service}_tripdata_"
    yyyy = "*" if year is None else f"{year:04d}"
    mm = "*" if month is None else f"{month:02d}"
    return f"{prefix}{yyyy}-{mm}*"


def file_inventory(spark: SparkSession, landing: str) -> DataFrame:
    """One row per file in a landing folder: service, month, size, and whether it is loaded.

    Only the listing is read, never the content. Files without ``yyyy-mm`` in
    their path are left out; the high-volume service is listed but out of scope.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(landing)
        .select("path", "length")
    )
    part = lambda i: F.regexp_extract("path", _SOURCE_SQL, i)
    return listed.filter(part(2) != "").select(
        F.col("path"),
        part(1).alias("file_type"),
        part(2).cast("int").alias("year"),
        part(3).cast("int").alias("month"),
        F.col("length").alias("bytes"),
        (F.lower(part(1)) != HIGH_VOLUME).alias("in_scope"),
    )


def match_columns(source: DataFrame, service: str, keep: list[str] | None = None) -> DataFrame:
    """Declared columns of a service in declared order, matched by name in any case."""
    present = {name.lower(): name for name in source.columns}
    picked = []
    for declared in COLUMN_MAP[service]:
        found = present.get(declared.lower())
        column = F.lit(None).cast("string") if found is None else source[found]
        picked.append(column.alias(declared))
    return source.select(*picked, *[source[name] for name in keep or []])


def listed_files(
    spark: SparkSession, landing: str, service: str, months: Months | None = None
) -> DataFrame:
    """path, year and month of a service's files, of the given months or of all."""
    path = F.col("_metadata.file_path")
    part = lambda i: F.regexp_extract("path", _SOURCE_SQL, i)
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(landing)
        .select(path.alias("path"))
        .filter(part(1) == service)
        .select("path", part(2).cast("int").alias("year"), part(3).cast("int").alias("month"))
    )
    return listed if months is None else listed.filter(_any_month(months))


def numbered_files(listed: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """path, year, month and number of the files that are not known yet.

    Numbers go on after those a month has given out, in the order of the paths.
    """
    place = F.row_number().over(Window.partitionBy("year", "month").orderBy("path")) - 1
    if known is None:
        return listed.withColumn("number", place)
    new = listed.join(known.select("path"), "path", "left_anti")
    given = known.groupBy("year", "month").agg((F.max("number") + 1).alias("_given"))
    numbered = new.withColumn("number", place).join(given, ["year", "month"], "left")
    return numbered.select(
        "path", "year", "month", (F.col("number") + F.coalesce("_given", F.lit(0))).alias("number")
    )


def schema_groups(
    spark: SparkSession, landing: str, service: str, months: Months
) -> tuple[dict[T.StructType, Months], dict[tuple[int, int], Exception]]:
    """Months by the schema their files have together, and what kept others from being read.

    Months whose files agree are one group, with the columns that any of them has. Where
    types differ or a file cannot be read, the months are halved until it is found.
    """
    if not months:
        return {}, {}
    try:
        reader = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true")
        return {reader.parquet(*_globs(landing, service, months)).schema: months}, {}
    except Exception as error:  # noqa: BLE001 - kept by month, the others go on
        if len(months) == 1:
            return {}, {months[0]: error}
    groups: dict[T.StructType, Months] = {}
    failed = {}
    for half in (months[: len(months) // 2], months[len(months) // 2 :]):
        own, bad = schema_groups(spark, landing, service, half)
        for schema, part in own.items():
            groups[schema] = groups.get(schema, []) + part
        failed |= bad
    return groups, failed


def read_group(
    spark: SparkSession, landing: str, service: str, months: Months, schema: T.StructType,
    files: DataFrame,
) -> DataFrame:
    """Rows of months that share a schema, with ``year``, ``month`` and ``trip_id``.

    ``files`` gives the number of each file; ids stay the same as long as it does.
    """
    scan = spark.read.option("recursiveFileLookup", "true").schema(schema).parquet(
        *_globs(landing, service, months)
    )
    located = scan.select(
        "*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_row")
    )
    lookup = files.select(F.col("path").alias("_path"), "year", "month", "number").filter(
        _any_month(months)
    )
    if lookup.count() <= BROADCAST_FILES:
        lookup = F.broadcast(lookup)
    joined = located.join(lookup, "_path")
    number = (F.col("year") - 1970) * 12 + F.col("month") - 1
    fits = (F.col("number") < (1 << FILE_BITS)) & (F.col("_row") < (1 << ROW_BITS))
    trip_id = (
        F.shiftleft(number.cast("long") * 4 + _service_number(service), FILE_BITS + ROW_BITS)
        + F.shiftleft(F.col("number").cast("long"), ROW_BITS)
        + F.col("_row")
    )
    no_room = F.raise_error(F.lit("a trip id has no room for this file number or row position"))
    numbered = joined.withColumn("trip_id", F.when(fits, trip_id).otherwise(no_room))
    return match_columns(numbered, service, keep=["trip_id", "year", "month"])


def read_raw(
    spark: SparkSession, landing: str, service: str, months: Months | None = None,
    files: DataFrame | None = None,
) -> DataFrame:
    """Rows of a service's sources, of the given months or of all.

    Columns are matched by name in every month, whichever months have them; where
    months store a column in different types, it is read as text. ``files`` may give
    the numbers of a file registry; without it files are numbered by their paths.
    """
    months = months or months_present(spark, landing, service)
    if not months:
        raise FileNotFoundError(f"no sources of {service}")
    groups, failed = schema_groups(spark, landing, service, months)
    for error in failed.values():
        raise error
    if files is None:
        files = numbered_files(listed_files(spark, landing, service, months))
    parts = [read_group(spark, landing, service, m, schema, files) for schema, m in groups.items()]
    # a column that a month lacks is empty there and gives no type
    types: dict[str, set[str]] = {}
    for (schema, _), part in zip(groups.items(), parts, strict=True):
        present = {name.lower() for name in schema.names}
        for field in part.schema.fields:
            own = {field.dataType.simpleString()} if field.name.lower() in present else set()
            types.setdefault(field.name, set()).update(own)
    mixed = {name: "string" if len(kinds) > 1 else next(iter(kinds), None) for name, kinds in types.items()}
    cast = [
        part.select(*[F.col(c).cast(mixed[c]) if mixed[c] else F.col(c) for c in part.columns])
        for part in parts
    ]
    return reduce(DataFrame.unionByName, cast)


def months_present(spark: SparkSession, landing: str, service: str) -> Months:
    """Months a service has sources for, in order (bounded by the calendar)."""
    rows = (
        file_inventory(spark, landing)
        .filter(F.col("file_type") == service)
        .select("year", "month")
        .distinct()
        .collect()
    )
    return sorted((row.year, row.month) for row in rows)


def _any_month(months: Months) -> Column:
    by_year: dict[int, list[int]] = {}
    for year, month in months:
        by_year.setdefault(year, []).append(month)
    tests = [(F.col("year") == y) & F.col("month").isin(m) for y, m in by_year.items()]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _globs(landing: str, service: str, months: Months) -> list[str]:
    return [f"{landing}/{source_glob(service, *month)}" for month in months]


def _service_number(service: str) -> int:
    return list(COLUMN_MAP).index(service)
