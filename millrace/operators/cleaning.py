"""Missing values, invalid values, duplicates and outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import HOT_ROWS, quantiles, same_keys, with_group_stats


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``column_name, n_missing, pct_missing``; one pass for all columns."""
    cols = list(cols or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)],
    )
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"m{i}").alias("n_missing"),
            F.try_divide(F.col(f"m{i}") * 100.0, F.col("n_rows")).alias("pct_missing"),
        )
        for i, c in enumerate(cols)
    ]
    return counts.select(F.inline(F.array(*cells)))


def missing_columns(df: DataFrame) -> DataFrame:
    """Columns that still hold nulls; empty when the table is complete."""
    return null_profile(df).where("n_missing > 0")


def fill_constant(df: DataFrame, values: dict) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def exact_mean(col: str, digits: int = 6) -> Column:
    """The mean of a column of at most ``digits`` decimals, from a whole-number sum.

    The order in which rows are added can't change it, so it also rounds alike everywhere.
    """
    unit = float(10**digits)
    total = F.sum(F.round(F.col(col) * unit).cast("long"))
    return F.try_divide(total, F.count(col)) / F.lit(unit)


def fill_mean(df: DataFrame, cols: Sequence[str], mean=F.avg) -> DataFrame:
    means = df.agg(*[mean(c).alias(c) for c in cols])
    return df.withColumns({c: F.coalesce(F.col(c), means.select(c).scalar()) for c in cols})


def fill_group_mean(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    stats = [F.avg(c).alias(f"__mean_{c}") for c in cols]
    filled = with_group_stats(df, by, *stats)
    return filled.withColumns({c: F.coalesce(F.col(c), F.col(f"__mean_{c}")) for c in cols}).drop(
        *[f"__mean_{c}" for c in cols]
    )


def group_modes(df: DataFrame, col: str, by: Sequence[str] = (), name: str | None = None) -> DataFrame:
    """Most frequent value per group, the smallest one on ties.

    Two aggregations, values first: no task holds all values of a group.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct((-F.col("n")).alias("rank"), F.col(col).alias("value")))
    return counts.groupBy(*by).agg(first["value"].alias(name or f"{col}_mode"))


def fill_mode(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.coalesce(F.col(col), group_modes(df, col).scalar()))


def fill_group_mode(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    keys = {k: f"__key_{i}" for i, k in enumerate(by)}
    modes = group_modes(df, col, by, "__mode").withColumnsRenamed(keys)
    cond = same_keys([(df[k], modes[a]) for k, a in keys.items()])
    return (
        df.join(modes, cond, "left")
        .withColumn(col, F.coalesce(F.col(col), F.col("__mode")))
        .drop("__mode", *keys.values())
    )


def replace_invalid(df: DataFrame, col: str, valid: Column, by: Sequence[str], digits: int = 0) -> DataFrame:
    """Invalid values become the rounded mean of the valid rows of their group.

    A group without a valid row takes the mean of all valid rows. Nulls stay null.
    """
    mean = F.avg(F.when(valid, F.col(col)))
    kept = with_group_stats(df, by, mean.alias("__valid_mean"))
    overall = df.agg(mean.alias("m")).scalar()
    kind = df.schema[col].dataType
    stand_in = F.round(F.coalesce(F.col("__valid_mean"), overall), digits).cast(kind)
    return kept.withColumn(col, F.when(~valid, stand_in).otherwise(F.col(col))).drop("__valid_mean")


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def drop_every_copy(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows whose values in ``cols`` occur exactly once; ``keep`` are other columns to carry."""
    once = df.groupBy(*cols).agg(
        F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in keep]
    )
    return once.where("__n = 1").drop("__n")


#: Times to the microsecond, with era and full offset; the default of JSON ends at the millisecond.
_LOSSLESS = {
    "timestampFormat": "G yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXXXX", "timestampNTZFormat": "G yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "dateFormat": "G yyyy-MM-dd",
}


def later_copies(df: DataFrame, cols: Sequence[str], row_key: str) -> DataFrame:
    """Rows that repeat an earlier row (all but the lowest ``row_key`` of equal rows).

    Rows are counted by a 256-bit digest of their content, so the content itself is moved once, and only to
    meet the digests that repeat. Copies are combined before the shuffle.
    """
    # A field that is null is left out of the text, so null and empty differ.
    digest = F.sha2(F.to_json(F.struct(*[F.col(c) for c in cols]), _LOSSLESS), 256)
    tagged = df.withColumn("__digest", digest)
    firsts = (
        tagged.groupBy(F.col("__digest").alias("__copy"))
        .agg(F.min(row_key).alias("__first"), F.count(F.lit(1)).alias("__n"))
        .where("__n > 1").drop("__n")
    )
    joined = tagged.join(firsts, (F.col("__digest") == F.col("__copy")) & (F.col(row_key) > F.col("__first")))
    return joined.select(*[tagged[c] for c in df.columns])


def outlier_counts(df: DataFrame, cols: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """``column_name, n_outliers`` beyond 1.5 times the quartile distance."""
    bounds = quantiles(df, cols, [0.25, 0.75], hot_rows=hot_rows)
    tests = []
    for i, c in enumerate(cols):
        low, high = (bounds.select(F.col(c)[j].alias(c)).scalar() for j in (0, 1))
        reach = (high - low) * 1.5
        outside = (F.col(c) < low - reach) | (F.col(c) > high + reach)
        tests.append(F.count_if(outside).alias(f"o{i}"))
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"o{i}").alias("n_outliers"))
        for i, c in enumerate(cols)
    ]
    return df.agg(*tests).select(F.inline(F.array(*cells)))
