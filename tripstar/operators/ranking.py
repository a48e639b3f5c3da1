"""Ranks and dense numbers over whole tables, without a window that one task computes.

Rows are dealt by ranges of the order, equal ones included, so a value that a third of all
rows share is spread too. Each range is ranked by itself; then the sizes of the ranges before
it are added, and a run of equal rows that crosses a border takes its rank along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstar.session import scratch_dir

RANKS = ["row_number", "rank", "dense_rank"]


def _sorted(name: str, direction: str) -> Column:
    """A sort order: ``asc`` and ``desc``, with NULL last in either."""
    return F.col(name).asc_nulls_last() if direction == "asc" else F.col(name).desc_nulls_last()


def ranked(rows: DataFrame, order: dict[str, str], by: list[str] | None = None, ranges: int = 64) -> DataFrame:
    """Add ``row_number``, ``rank`` and ``dense_rank`` (bigint) by ``order`` within ``by``.

    ``order`` maps columns to ``asc`` or ``desc``; NULL comes last, and is equal to NULL. Rows
    that are equal in it are numbered by a hash of their other columns. ``ranges`` is the
    number of tasks; the table of their sizes has a row for each range and group in it.
    """
    by = by or []
    spark = rows.sparkSession
    groups = [F.col(c).asc_nulls_last() for c in by]
    wanted = [_sorted(c, d) for c, d in order.items()]
    marked = rows.withColumn("_tie", F.xxhash64(*rows.columns))
    dealt = marked.repartitionByRange(ranges, *groups, *wanted, "_tie").withColumn("_range", F.spark_partition_id())
    # ranges are fixed before anything is computed from them
    path = scratch_dir(spark, "ranges")
    dealt.write.parquet(path)
    dealt = spark.read.parquet(path)
    inside = Window.partitionBy("_range", *by)
    in_order = inside.orderBy(*wanted)
    local = dealt.withColumns({
        "_row": F.row_number().over(inside.orderBy(*wanted, "_tie")), "_rank": F.rank().over(in_order),
        "_dense": F.dense_rank().over(in_order),
    })
    borders = _borders(local, list(order), by)
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in ["_range", *by]]
    test = same[0]
    for one in same[1:]:
        test = test & one
    joined = local.join(borders, test)
    first = (F.col("_dense") == 1) & F.col("_tied")
    return joined.select(
        *rows.columns,
        (F.col("_rows_before") + F.col("_row")).alias("row_number"),
        F.when(first, F.col("_carried")).otherwise(F.col("_rows_before") + F.col("_rank")).alias("rank"),
        (F.col("_dense_before") + F.col("_dense")).alias("dense_rank"),
    )


def _borders(local: DataFrame, order: list[str], by: list[str]) -> DataFrame:
    """For each range and group: what lies before it, and whether its first rows equal the last before."""
    value = F.struct(*order)
    sizes = local.groupBy("_range", *by).agg(
        F.count(F.lit(1)).alias("_n"), F.max("_dense").cast("bigint").alias("_d"), F.max("_rank").alias("_last_rank"),
        F.min_by(value, "_row").alias("_first"), F.max_by(value, "_row").alias("_last"),
    )
    along = Window.partitionBy(*by).orderBy("_range")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    tied = F.coalesce(F.col("_first").eqNullSafe(F.lag("_last").over(along)) & F.lag("_n").over(along).isNotNull(), F.lit(False))
    sizes = sizes.withColumns({
        "_tied": tied, "_rows_before": F.coalesce(F.sum("_n").over(before), F.lit(0)),
    })
    # a range of one value that began before it does not begin a new rank
    begun = F.when(~(F.col("_tied") & (F.col("_d") == 1)), F.col("_rows_before") + F.col("_last_rank"))
    up_to = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = sizes.withColumn("_of_last", F.last(begun, ignorenulls=True).over(up_to))
    distinct = F.col("_d") - F.when(F.col("_tied"), 1).otherwise(0)
    return sizes.select(
        *[F.col(c).alias(f"_of_{c}") for c in ["_range", *by]], "_tied", "_rows_before",
        F.lag("_of_last").over(along).alias("_carried"),
        (F.coalesce(F.sum(distinct).over(before), F.lit(0)) - F.when(F.col("_tied"), 1).otherwise(0)).alias("_dense_before"),
    )
