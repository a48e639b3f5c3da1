"""The star schema as a value: one fact and its dimensions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Star:
    """Trip fact with dimensions.

    Dimensions built by this library have a size fixed by construction (a
    calendar, the minutes of a day, short lists) and are broadcast. Names in
    ``supplied`` are tables of the caller's, of unknown size: those are joined
    without a hint, so the optimizer decides from their statistics.
    """

    fact_trips: DataFrame
    dim_date: DataFrame
    dim_time: DataFrame
    dim_location: DataFrame
    dim_vendor: DataFrame
    dim_payment_type: DataFrame
    dim_rate_code: DataFrame
    dim_trip_type: DataFrame
    dim_file_source: DataFrame
    dim_store_fwd_flag: DataFrame
    supplied: frozenset[str] = field(default_factory=frozenset)

    def attach(
        self,
        rows: DataFrame,
        dim: str,
        on: str,
        attributes: dict[str, str | Column],
        how: str = "inner",
    ) -> DataFrame:
        """Join attributes of a dimension to ``rows``.

        ``on`` is the key column of ``rows``; ``attributes`` maps new column
        names to dimension columns. Only those columns are carried.
        """
        table: DataFrame = getattr(self, dim)
        key = table.columns[0]
        side = table.select(
            F.col(key).alias("_key"),
            *[
                (F.col(c) if isinstance(c, str) else c).alias(name)
                for name, c in attributes.items()
            ],
        )
        if dim not in self.supplied:
            side = F.broadcast(side)
        return rows.join(side, rows[on] == side["_key"], how).drop("_key")
