"""Shared helpers: reading the tables, shared scratch tables, word and hash expressions."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.session import scratch_dir

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"


def reachable(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver found it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """Write rows into the shared scratch folder and read them back.

    Cuts the lineage: a later stage, or a retry after a lost executor, reads the files.
    """
    spark = rows.sparkSession
    reachable(spark)
    path = scratch_dir(spark, purpose)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def words(text: Column) -> Column:
    """Words of a text, in order; null gives none."""
    split = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    return F.filter(split, lambda w: w != "")


def n_words(text: Column) -> Column:
    """Number of words (long); null gives 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column) -> Column:
    """Whether a document belongs to the quarter no model learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def splits(n_rows: int, per_split: int) -> int:
    """Partitions for so many rows; at least one, and no upper limit."""
    return max(1, -(-n_rows // per_split))
