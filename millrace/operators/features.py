"""Feature preparation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.labels import class_of
from millrace.functions.scalar import scaled
from millrace.operators.ordered import HOT_ROWS, quantiles
from millrace.session import written


def category_codes(df: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """``attr, code, label``: alphabetical codes from 0, for one or more columns.

    Labels are made distinct, range-sorted and numbered inside their range, after all labels of earlier ranges, so
    a column with as many labels as rows is never gathered in one task.
    """
    pairs = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(a).alias("attr"), F.col(a).cast("string").alias("label"))
                    for a in attrs
                ]
            )
        )
    )
    return _numbered(pairs.where(F.col("label").isNotNull()).distinct())


def _numbered(labels: DataFrame) -> DataFrame:
    """Distinct ``attr, label`` with their ``code`` per ``attr`` in the order of the labels."""
    ordered = labels.repartitionByRange("attr", "label").sortWithinPartitions("attr", "label")
    # The partition stands in the upper bits of the number, the row's place in it in the lower 33.
    stored = written(ordered.withColumn("__seq", F.monotonically_increasing_id()), "labels")
    stored = stored.withColumn("__range", F.shiftright("__seq", 33))
    ahead = W.partitionBy("attr").orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        stored.groupBy("attr", "__range").agg(F.min("__seq").alias("first"), F.count(F.lit(1)).alias("held"))
        .select("attr", "__range", (F.coalesce(F.sum("held").over(ahead), F.lit(0)) - F.col("first")).alias("shift"))
    )
    placed = stored.join(starts, ["attr", "__range"])
    return placed.select("attr", (F.col("__seq") + F.col("shift")).cast("int").alias("code"), "label")


def extended_codes(codes: DataFrame, df: DataFrame) -> DataFrame:
    """``codes`` with the labels of ``df`` they lack behind them; no label changes its number."""
    attrs = [r["attr"] for r in codes.select("attr").distinct().collect()]  # as many as columns
    known = codes.select(F.col("attr").alias("__attr"), F.col("label").alias("__label"))
    found = category_codes(df, [a for a in attrs if a in df.columns]).drop("code")
    fresh = found.join(known, (F.col("attr") == F.col("__attr")) & (F.col("label") == F.col("__label")), "left_anti")
    ends = codes.groupBy(F.col("attr").alias("__attr")).agg((F.max("code") + 1).alias("__end"))
    added = _numbered(fresh).join(ends, F.col("attr") == F.col("__attr"))
    return codes.select("attr", "code", "label").unionByName(
        added.select("attr", (F.col("code") + F.col("__end")).cast("int").alias("code"), "label")
    )


def with_codes(
    df: DataFrame, attr: str, name: str | None = None, codes: DataFrame | None = None, unseen: bool = False
) -> DataFrame:
    """``df`` with the code of ``attr``, by ``codes`` made earlier or by its own labels.

    A label that ``codes`` lack has no code or, with ``unseen``, the number behind the last; null has none.
    """
    fitted = category_codes(df, [attr]) if codes is None else codes.where(F.col("attr") == attr)
    table = fitted.select(F.col("label").alias("__label"), F.col("code").alias("__code"))
    joined = df.join(table, df[attr].cast("string") == table["__label"], "left")
    code = F.col("__code")
    if unseen:
        end = fitted.agg(F.coalesce(F.max("code") + 1, F.lit(0)).alias("end")).scalar()
        code = F.when(F.col(attr).isNotNull(), F.coalesce(code, end))
    return joined.withColumn("__code", code).withColumnRenamed("__code", name or f"{attr}_ind").drop("__label")


def cardinalities(df: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """``attr, n_categories``, for the bin limit of tree learners."""
    counts = df.agg(*[F.countDistinct(F.col(a).cast("string")).alias(f"n{i}") for i, a in enumerate(attrs)])
    cells = [F.struct(F.lit(a).alias("attr"), F.col(f"n{i}").alias("n_categories")) for i, a in enumerate(attrs)]
    return counts.select(F.inline(F.array(*cells)))


def min_max(df: DataFrame, cols: Sequence[str], suffix: str = "_sc", constant: float | None = 0.0) -> DataFrame:
    """Scale to 0..1; a column with a single value becomes ``constant``."""
    stats = df.agg(*[f(c).alias(f"{t}_{c}") for c in cols for t, f in (("lo", F.min), ("hi", F.max))])
    out = {}
    for c in cols:
        low, high = stats.select(f"lo_{c}").scalar(), stats.select(f"hi_{c}").scalar()
        value = scaled(c, low, high)
        if constant is not None:
            value = F.when(low == high, F.when(F.col(c).isNotNull(), F.lit(constant))).otherwise(value)
        out[f"{c}{suffix}"] = value
    return df.withColumns(out)


def z_score(df: DataFrame, cols: Sequence[str], suffix: str = "_z") -> DataFrame:
    """Distance from the mean in population standard deviations; 0 for a constant column."""
    stats = df.agg(
        *[f(c).alias(f"{t}_{c}") for c in cols for t, f in (("m", F.avg), ("s", F.stddev_pop))]
    )
    out = {}
    for c in cols:
        mean, sd = stats.select(f"m_{c}").scalar(), stats.select(f"s_{c}").scalar()
        out[f"{c}{suffix}"] = (F.col(c) - mean) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)
    return df.withColumns(out)


def quantile_codes(
    df: DataFrame, cols: Sequence[str], bins: int, suffix: str = "_discr", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Ordinal codes of equal-count bins; edges that coincide are merged."""
    inner = [i / bins for i in range(bins + 1)]
    row = quantiles(df, cols, inner, hot_rows=hot_rows).first()
    out = {}
    for c in cols:
        edges = []
        for e in row[c]:
            if not edges or e - edges[-1] > 1e-8:
                edges.append(e)
        out[f"{c}{suffix}"] = F.when(F.col(c).isNotNull(), class_of(c, edges[1:-1]))
    return df.withColumns(out)


def label_list(df: DataFrame, target: str) -> DataFrame:
    return df.select(target).distinct().orderBy(target)


def constant_columns(df: DataFrame, attrs: Sequence[str]) -> list[str]:
    """The columns of ``attrs`` that have fewer than two distinct values."""
    counts = df.agg(*[(F.min(F.col(a).cast("string")) < F.max(F.col(a).cast("string"))).alias(a) for a in attrs]).first()
    return [a for a in attrs if not counts[a]]


def empty_columns(df: DataFrame, attrs: Sequence[str]) -> list[str]:
    """The columns of ``attrs`` without any value."""
    counts = df.agg(*[F.count(a).alias(a) for a in attrs]).first()
    return [a for a in attrs if not counts[a]]


def preparation(categories: Sequence[str], numbers: Sequence[str], constant: Sequence[str] = ()) -> Pipeline:
    """Two feature sets in one pipeline: one-hot plus scaled, and indexed plus raw for trees.

    A category with n values has n - 1 slots, so one of ``constant`` (see ``constant_columns``) has none; its index stays.
    """
    indexed = [f"{c}_ind" for c in categories]
    varied = [c for c in categories if c not in constant]
    hot = [f"{c}_vec" for c in varied]
    encoded = [OneHotEncoder(inputCols=[f"{c}_ind" for c in varied], outputCols=hot)] if varied else []
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(numbers), outputCol="numeric_features"),
            MinMaxScaler(inputCol="numeric_features", outputCol="scaled_features"),
            StringIndexer(inputCols=list(categories), outputCols=indexed, stringOrderType="alphabetAsc"),
            *encoded,
            VectorAssembler(inputCols=[*hot, "scaled_features"], outputCol="features"),
            VectorAssembler(inputCols=[*indexed, *numbers], outputCol="features_trees"),
        ]
    )


def assembled(df: DataFrame, cols: Sequence[str], name: str = "features", invalid: str = "error") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=name, handleInvalid=invalid).transform(df)
