"""All registered queries and their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstar.catalog.analytics import ANALYTICS, Query
from tripstar.catalog.operations import OPERATIONS
from tripstar.catalog.oracle_insights import INSIGHT_CHECKS
from tripstar.catalog.oracle_marts import DIMENSION_CHECKS, FACT_CHECKS, MART_CHECKS
from tripstar.catalog.oracle_operations import OPERATION_CHECKS
from tripstar.catalog.oracle_upkeep import UPKEEP_CHECKS
from tripstar.catalog.upkeep import UPKEEP
from tripstar.functions import exact
from tripstar.session import configure


def decimals_as_doubles(result: DataFrame) -> DataFrame:
    """Show decimals as doubles, the one number type both engines print alike."""
    if not any(isinstance(f.dataType, T.DecimalType) for f in result.schema.fields):
        return result
    return result.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in result.schema.fields
        ]
    )


def _registered(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with exact.comparable():
            return decimals_as_doubles(query(configure(spark), sf_dir))

    return run


def all_queries() -> dict[str, Query]:
    return {name: _registered(query) for name, query in {**ANALYTICS, **OPERATIONS, **UPKEEP}.items()}


def all_checks() -> dict[str, str]:
    return {
        **FACT_CHECKS,
        **DIMENSION_CHECKS,
        **MART_CHECKS,
        **INSIGHT_CHECKS,
        **OPERATION_CHECKS,
        **UPKEEP_CHECKS,
    }
