"""Files clustered on several keys at once: row groups can be skipped by a filter on any of them.

Each key is cut into ranges of about equal numbers of rows, the bits of a row's range numbers
are interleaved, and rows are dealt to files by ranges of the result. Sorting by one key after
the other would let the second one be found in nearly every file.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 6


def key_ranges(rows: DataFrame, keys: dict[str, Column], bits: int = BITS) -> dict[str, list]:
    """For each key the values at which a further range begins, at most ``2**bits - 1``."""
    shares = [i / 2**bits for i in range(1, 2**bits)]
    found = rows.agg(*[F.percentile_approx(c, shares, 2 ** (bits + 8)).alias(k) for k, c in keys.items()]).first()
    lows = rows.agg(*[F.min(c).alias(k) for k, c in keys.items()]).first()
    return {k: sorted({v for v in found[k] or [] if v > lows[k]}) for k in keys}


def range_number(key: Column, starts: list, bits: int = BITS) -> Column:
    """The number of the range that a value lies in, spread over ``bits`` bits; NULL counts as the first."""
    passed = [F.when(key >= F.lit(s), 1).otherwise(0) for s in starts]
    number = reduce(lambda a, b: a + b, passed, F.lit(0))
    return F.floor(number * F.lit(2**bits) / F.lit(len(starts) + 1)).cast("int")


def interleaved(numbers: list[Column], bits: int = BITS) -> Column:
    """One number whose bits are taken from the given ones in turn, highest first."""
    out = F.lit(0).cast("bigint")
    for bit in range(bits - 1, -1, -1):
        for number in numbers:
            out = out * 2 + F.shiftright(number, bit).bitwiseAND(F.lit(1))
    return out


def write_clustered(rows: DataFrame, path: str, keys: dict[str, Column], files: int, bits: int = BITS) -> None:
    """Write rows into about ``files`` files, clustered on all keys alike.

    ``keys`` names whole numbers whose order is that of the columns filtered by. Rows that
    are equal in all of them are dealt by a hash, so a hot one is spread over several files.
    """
    starts = key_ranges(rows, keys, bits)
    place = interleaved([range_number(keys[k], starts[k], bits) for k in keys], bits)
    placed = rows.withColumn("_place", place).withColumn("_spread", F.xxhash64(*rows.columns))
    dealt = placed.repartitionByRange(files, "_place", "_spread").sortWithinPartitions("_place")
    dealt.drop("_place", "_spread").write.parquet(path)
