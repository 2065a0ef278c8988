"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.layout import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, spread over all cores for functions that work through whole texts."""
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def r6(column: Column | str) -> Column:
    """Doubles are compared at six places; adding zero removes a negative zero."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column.cast("double"), 6) + F.lit(0.0)


def r4(column: Column | str) -> Column:
    """Four places, for spreads of large numbers."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column.cast("double"), 4) + F.lit(0.0)


def cents(column: Column | str) -> Column:
    """Money as an exact decimal, so sums do not depend on the order of rows."""
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("decimal(38,6)")
