"""Names, functions and SQL checks of the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import Tables, open_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``key``; ``sql`` gives the same rows on the same tables."""

    def register(fn: Callable[[Tables], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = lambda spark, sf_dir: fn(open_tables(spark, sf_dir))
        if sql:
            CHECKS[key] = sql.strip()
        return fn

    return register


def r(col: Column | str, digits: int = 6) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c, digits)


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def exact_mean_sql(col: str, over: str) -> str:
    """The mean over a window from a whole-number sum, as ``cleaning.exact_mean`` takes it."""
    return (
        f"cast(sum(cast(round({col} * 1000000.0) as bigint)) over ({over}) as double)"
        f" / nullif(count({col}) over ({over}), 0) / 1000000.0"
    )
