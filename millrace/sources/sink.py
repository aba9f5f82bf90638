"""Table sinks. Writes stay parallel unless one file is asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_DRIVER_ROWS = 100_000


def save_table(
    df: DataFrame,
    path: str,
    save_as: str = "csv",
    single_file: bool = False,
    partition_by: list[str] | None = None,
    rows_per_file: int | None = None,
) -> str:
    """Overwrite ``path`` with ``df`` as CSV, JSON or Parquet.

    A CSV file whose cells hold line breaks is read whole by one task; ``rows_per_file`` makes more, smaller files.
    """
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if save_as == "csv":
        writer = writer.option("header", True).option("escape", '"')
    elif save_as not in ("json", "parquet"):
        raise ValueError(f"save_as must be csv, json or parquet, not {save_as!r}")
    writer.format(save_as).save(path)
    return path


def save_labelled(df: DataFrame, path: str) -> str:
    df.select("label", "features").write.mode("overwrite").parquet(path)
    return path


def prediction_labels(
    df: DataFrame, row_key: str, prediction: str, name: str, no: str = "no", yes: str = "yes"
) -> DataFrame:
    """``row_key, name`` with the 0/1 prediction written out as words."""
    word: Column = F.when(F.col(prediction) == 0, F.lit(no)).otherwise(F.lit(yes))
    return df.select(F.col(row_key), word.alias(name))


def save_mapping(df: DataFrame, attrs: list[str], path: str) -> str:
    """Store ``attr, code, label`` for every category, codes in alphabetical order."""
    from millrace.operators.features import category_codes

    category_codes(df, attrs).write.mode("overwrite").parquet(path)
    return path


def bounded_rows(df: DataFrame, limit: int = MAX_DRIVER_ROWS) -> list:
    """Rows of a small result on the driver; a larger result is refused, never cut."""
    rows = df.take(limit + 1)
    if len(rows) > limit:
        raise ValueError(f"result has more than {limit} rows; write it with save_table")
    return rows
