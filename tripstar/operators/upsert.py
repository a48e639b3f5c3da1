"""Merging new rows into a table by key, and replacing a table as a whole.

Incoming rows are first reduced to one per key, the last by a stated order, and NULL is a
key value like any other. A table is never overwritten while it is read: a change writes a
new version and then records it as current, or stages the partitions that it touches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.session import scratch_dir


def one_per_key(incoming: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """The last incoming row of each key by ``order``, then by the values of all columns.

    A maximum over structs: many rows of one key are reduced inside the tasks.
    """
    rest = [c for c in incoming.columns if c not in keys]
    if not rest:
        return incoming.dropDuplicates(keys)
    first = [c for c in order or [] if c in rest]
    ranked = F.max(F.struct(*first, *[c for c in rest if c not in first])).alias("_last")
    last = incoming.groupBy(*keys).agg(ranked)
    return last.select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in incoming.columns])


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equal keys; NULL is a key value like any other."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_key_{k}"]) for k in keys])


def insert_only(
    existing: DataFrame, incoming: DataFrame, keys: list[str], order: list[str] | None = None
) -> DataFrame:
    """Existing rows, and one incoming row of each key that is new."""
    known = existing.select(*[F.col(k).alias(f"_key_{k}") for k in keys]).distinct()
    new = one_per_key(incoming, keys, order)
    return existing.unionByName(new.join(known, _same(new, known, keys), "left_anti"))


def update_only(
    existing: DataFrame, incoming: DataFrame, keys: list[str], columns: list[str],
    order: list[str] | None = None,
) -> DataFrame:
    """Existing rows with ``columns`` replaced where the key comes in; nothing is added."""
    new = _marked(one_per_key(incoming, keys, order), keys, columns)
    joined = existing.join(new, _same(existing, new, keys), "left")
    return joined.select(*[_replaced(c, columns) for c in existing.columns])


def upsert(
    existing: DataFrame, incoming: DataFrame, keys: list[str], columns: list[str],
    order: list[str] | None = None,
) -> DataFrame:
    """Replace ``columns`` of known keys, keep their other columns, add new keys."""
    others = [c for c in existing.columns if c not in keys]
    new = _marked(one_per_key(incoming, keys, order), keys, others)
    old = existing.withColumn("_old", F.lit(True))
    joined = old.join(new, _same(old, new, keys), "full_outer")

    def value(column: str):
        if column in keys:
            return F.when(F.col("_old"), F.col(column)).otherwise(F.col(f"_key_{column}")).alias(column)
        kept = F.col("_old") if column not in columns else F.col("_new").isNull()
        return F.when(kept, F.col(column)).otherwise(F.col(f"_new_{column}")).alias(column)

    return joined.select(*[value(c) for c in existing.columns])


def _marked(incoming: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    return incoming.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        *[F.col(c).alias(f"_new_{c}") for c in columns],
        F.lit(True).alias("_new"),
    )


def _replaced(column: str, columns: list[str]):
    if column not in columns:
        return F.col(column)
    return F.when(F.col("_new"), F.col(f"_new_{column}")).otherwise(F.col(column)).alias(column)


class VersionedTable:
    """A table kept as a row of full versions, with a small log naming the current one."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root
        self._log = f"{root}/versions"

    def version(self) -> int:
        """Number of the current version; 0 before the first."""
        if not path_exists(self.spark, self._log):
            return 0
        log = self.spark.read.schema("version int").parquet(self._log)
        return log.agg(F.max("version")).first()[0] or 0

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/data/v{self.version():06d}")

    def replace(self, rows: DataFrame) -> None:
        """Write rows (which may read the current version) as the new current version."""
        number = self.version() + 1
        rows.write.mode("overwrite").parquet(f"{self.root}/data/v{number:06d}")
        entry = self.spark.range(1).select(F.lit(number).alias("version"))
        entry.write.mode("append").parquet(self._log)
        if number > 2:  # readers may still be on the version before this one
            gone = self.spark.createDataFrame([], rows.schema)
            gone.write.mode("overwrite").parquet(f"{self.root}/data/v{number - 2:06d}")

    def merge(self, incoming: DataFrame, keys: list[str], columns: list[str]) -> None:
        if self.version() == 0:
            self.replace(incoming)
        else:
            self.replace(upsert(self.read(), incoming, keys, columns))


def merge_partitions(
    spark: SparkSession, path: str, incoming: DataFrame, keys: list[str], columns: list[str],
    by: list[str], order: list[str] | None = None,
) -> None:
    """Upsert into a table partitioned by some of the keys; only touched partitions are rewritten.

    The partitions an incoming batch touches are bounded by the calendar. Merged rows are
    staged first, so a retry after a failure finds the old partitions or the new ones.
    """
    rows = one_per_key(incoming, keys, order)
    if path_exists(spark, path):
        touched = rows.select(*by).distinct().collect()
        test = reduce(
            lambda a, b: a | b,
            [reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.lit(r[k])) for k in by]) for r in touched],
            F.lit(False),
        )
        existing = spark.read.parquet(path).filter(test).select(*incoming.columns)
        rows = upsert(existing, rows, keys, columns)
    staged = scratch_dir(spark, "merge")
    rows.write.parquet(staged)
    placed = spark.read.parquet(staged).hint("rebalance", *by)
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table folder can be read."""
    try:
        return bool(spark.read.parquet(path).columns)
    except AnalysisException:
        return False
