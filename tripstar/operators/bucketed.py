"""Tables bucketed and sorted by key: what comes in is shuffled, what is stored is not.

Keys are told apart by their hash, which the table is bucketed by, and then by their values,
NULL being a value like any other.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.operators.upsert import one_per_key
from tripstar.session import scratch_dir

BUCKET = "_bucket_key"


class BucketedTable:
    """A table of the session's catalog, bucketed by the hash of its keys.

    Give the number of buckets for the size the table will have: some hundred megabytes each.
    """

    def __init__(self, spark: SparkSession, keys: list[str], buckets: int, path: str | None = None) -> None:
        self.spark, self.keys, self.buckets = spark, keys, buckets
        self.path = path or scratch_dir(spark, "bucketed")
        self.name = f"bucketed_{uuid.uuid4().hex}"

    def _keyed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, F.xxhash64(*self.keys))

    def _same(self, left: DataFrame, right: DataFrame) -> Column:
        def one(key: str) -> Column:
            # not written as a null-safe equality, which would become a key of the join
            a, b = left[key], right[f"_key_{key}"]
            return F.coalesce(a == b, a.isNull() & b.isNull())

        return reduce(lambda x, y: x & y, map(one, self.keys), left[BUCKET] == right["_key_hash"])

    def write(self, rows: DataFrame) -> BucketedTable:
        """Store rows; one shuffle by bucket, so that each bucket is one sorted file."""
        placed = self._keyed(rows).repartition(self.buckets, BUCKET)
        writer = placed.write.format("parquet").bucketBy(self.buckets, BUCKET).sortBy(BUCKET)
        writer.option("path", self.path).mode("overwrite").saveAsTable(self.name)
        return self

    def _stored(self) -> DataFrame:
        return self.spark.table(self.name)

    def read(self) -> DataFrame:
        return self._stored().drop(BUCKET)

    def missing(self, incoming: DataFrame) -> DataFrame:
        """Incoming rows whose key the table does not hold: an anti join that shuffles them alone."""
        new = self._keyed(incoming)
        known = self._stored().select(*[F.col(k).alias(f"_key_{k}") for k in self.keys], F.col(BUCKET).alias("_key_hash"))
        return new.join(known, self._same(new, known), "left_anti").drop(BUCKET)

    def merged(self, incoming: DataFrame, columns: list[str], order: list[str] | None = None) -> DataFrame:
        """The stored rows with ``columns`` replaced where their key comes in, and the new keys.

        Of several incoming rows of a key the last by ``order`` counts. Replaced rows keep their
        other columns. Incoming rows are shuffled by bucket once, for both uses of them.
        """
        held = self._stored()
        others = [c for c in held.columns if c not in [*self.keys, BUCKET]]
        new = self._keyed(one_per_key(incoming, self.keys, order)).repartition(self.buckets, BUCKET)
        new = new.select(
            *[F.col(k).alias(f"_key_{k}") for k in self.keys], F.col(BUCKET).alias("_key_hash"),
            *[F.col(c).alias(f"_new_{c}") for c in others], F.lit(True).alias("_new"),
        )
        old = held.withColumn("_old", F.lit(True))
        joined = old.join(new, self._same(old, new), "full_outer")

        def value(column: str) -> Column:
            if column in self.keys:
                return F.when(F.col("_old"), F.col(column)).otherwise(F.col(f"_key_{column}")).alias(column)
            kept = F.col("_old") if column not in columns else F.col("_new").isNull()
            return F.when(kept, F.col(column)).otherwise(F.col(f"_new_{column}")).alias(column)

        return joined.select(*[value(c) for c in held.columns if c != BUCKET])

    def merge(self, incoming: DataFrame, columns: list[str], order: list[str] | None = None) -> BucketedTable:
        """The table after a merge, as a new one beside this, which readers may still be using."""
        return BucketedTable(self.spark, self.keys, self.buckets).write(self.merged(incoming, columns, order))
