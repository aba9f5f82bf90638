"""Joins (J1-J9): dimension joins, outer joins, lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalar import mean_of


def with_dimension(facts: DataFrame, dim: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Inner equi-join. No hint: Catalyst and AQE broadcast the side measured as small, and
    otherwise sort-merge with skewed keys split."""
    return facts.join(dim, [keys] if isinstance(keys, str) else list(keys), "inner")


def outer_filled(left: DataFrame, right: DataFrame, key: str, fill: Mapping[str, object]) -> DataFrame:
    """Full outer join; the listed columns get a constant where a side has no row."""
    joined = left.join(right, [key], "full")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items()})


def trend_table(lookup: DataFrame, key: str, years: Sequence[str], order: str | None = None) -> DataFrame:
    """``key, trend``: mean over the year columns; the first row (by ``order``) of a key counts."""
    trend = mean_of([F.col(y).cast("double") for y in years])
    picked: Column = F.min_by(trend, F.col(order)) if order else F.min(trend)
    return lookup.groupBy(key).agg(picked.alias("trend"))


def lookup_trend(df: DataFrame, trends: DataFrame, key: str, name: str) -> DataFrame:
    """Left join to a trend table; a key without a row gives null."""
    return df.join(trends.withColumnRenamed("trend", name), [key], "left")


def list_trend(df: DataFrame, trends: DataFrame, row_key: str, items: str, item_key: str, name: str) -> DataFrame:
    """``row_key, name``: mean trend over the elements of a list; unknown elements do not count."""
    parts = df.select(row_key, F.explode_outer(items).alias(item_key))
    return parts.join(trends, [item_key], "left").groupBy(row_key).agg(F.avg("trend").alias(name))


def write_back(df: DataFrame, predictions: DataFrame, row_key: str, missing: object = None) -> DataFrame:
    """Predictions joined to their source rows by key; rows without one keep ``missing``."""
    joined = df.join(predictions, [row_key], "left")
    if missing is None:
        return joined
    added = [c for c in predictions.columns if c != row_key]
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(missing)) for c in added})
