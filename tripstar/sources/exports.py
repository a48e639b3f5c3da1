"""CSV export of a result, and reading it back with the same schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def export_csv(result: DataFrame, path: str) -> None:
    """Write a result as CSV with a header, one file per partition."""
    result.write.mode("overwrite").option("header", "true").csv(path)


def import_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.option("header", "true").schema(schema).csv(path)
