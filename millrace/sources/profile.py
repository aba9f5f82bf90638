"""Table profile: one row per column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(df: DataFrame) -> DataFrame:
    """``column_name, column_type, n_rows, n_values`` in one pass over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.col(c)).alias(f"v{i}") for i, c in enumerate(df.columns)],
    )
    cells = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("column_type"),
            F.col("n_rows"),
            F.col(f"v{i}").alias("n_values"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return counts.select(F.inline(F.array(*cells)))
