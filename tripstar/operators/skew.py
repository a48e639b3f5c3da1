"""Joins with a table of the caller's in which a few keys hold much of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_KEYS = 64
HEAVY = 0.02  # share of the rows from which on a key is salted
SALTS = 16


def heavy_keys(rows: DataFrame, on: str, share: float = HEAVY, most: int = MOST_KEYS) -> list:
    """Keys that hold about ``share`` of the rows or more, from a sketch of fixed size.

    An estimate only decides whether a key is salted, never what is joined.
    """
    found = rows.agg(F.count(on).alias("n"), F.call_function("approx_top_k", F.col(on), F.lit(most)).alias("top")).first()
    return [r["item"] for r in found.top or [] if r["item"] is not None and r["count"] >= share * found.n]


def salted_join(
    rows: DataFrame, table: DataFrame, on: str, key: str, how: str = "inner",
    share: float = HEAVY, salts: int = SALTS,
) -> DataFrame:
    """Join rows to a table on ``rows[on] = table[key]``, heavy keys spread over ``salts`` tasks.

    The table's rows of the heavy keys, and only those, are repeated for each salt. ``how`` is
    ``inner`` or ``left``. Columns of both sides are kept; they must have different names.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"not a salted join: {how}")
    heavy = heavy_keys(rows, on, share)
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int")
    salted = rows.withColumn("_salt", F.when(F.col(on).isin(heavy), salt).otherwise(0) if heavy else F.lit(0))
    every = F.sequence(F.lit(0), F.when(F.col(key).isin(heavy), salts - 1).otherwise(0) if heavy else F.lit(0))
    repeated = table.withColumn("_table_salt", F.explode(every))
    test = (salted[on] == repeated[key]) & (salted["_salt"] == repeated["_table_salt"])
    return salted.join(repeated, test, how).drop("_salt", "_table_salt")
