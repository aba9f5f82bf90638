"""Silhouette scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.features import assembled
from millrace.operators.stats import category_counts


def silhouette(df: DataFrame, dims: Sequence[str], label: str) -> float:
    """Mean silhouette with squared Euclidean distance; cost grows linearly with the rows."""
    rows = assembled(df, dims, "__features").select("__features", F.col(label).cast("double").alias("__label"))
    return ClusteringEvaluator(featuresCol="__features", predictionCol="__label").evaluate(rows)


def silhouette_plain(
    df: DataFrame, row_key: str, dims: Sequence[str], label: str, max_rows: int = 20_000, block: int = 500
) -> DataFrame:
    """``row_key, silhouette`` with plain Euclidean distance.

    The plain form has no shortcut: each row needs its mean distance to every cluster, so work
    grows with the square of the rows. A table above ``max_rows`` is refused, never cut; use
    ``silhouette`` there. Rows are dealt into blocks; each pair of blocks is one small task that
    returns sums per row and cluster, not pairs.
    """
    import numpy as np
    import pandas as pd

    n = df.count()
    if n > max_rows:
        raise ValueError(f"{n} rows; the plain form takes at most {max_rows}, use silhouette()")
    blocks = max(1, -(-n // block))
    deal = F.pmod(F.xxhash64(row_key), F.lit(blocks)).cast("int")
    rows = df.select(
        F.col(row_key).alias("id"), F.array(*[F.col(d).cast("double") for d in dims]).alias("x"),
        F.col(label).cast("bigint").alias("label"), deal.alias("own"),
    )
    asked = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def sums(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"id": [], "label": [], "to": [], "total": []})
        a, b = np.stack(left["x"].to_numpy()), np.stack(right["x"].to_numpy())
        dist = np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2))
        out = [
            pd.DataFrame(
                {"id": left["id"], "label": left["label"], "to": k, "total": dist[:, (right["label"] == k).to_numpy()].sum(axis=1)}
            )
            for k in right["label"].unique()
        ]
        return pd.concat(out)

    partial = asked.groupBy("other").cogroup(rows.groupBy("own")).applyInPandas(
        sums, "id bigint, label bigint, to bigint, total double"
    )
    totals = partial.groupBy("id", "label", "to").agg(F.sum("total").alias("total"))
    sizes = category_counts(rows, "label").withColumnsRenamed({"label": "size_of"})
    means = totals.join(sizes, F.col("to") == F.col("size_of"))
    own = F.col("to") == F.col("label")
    per = means.groupBy("id").agg(
        F.max(F.when(own, F.col("n"))).alias("size"),
        F.max(F.when(own, F.try_divide("total", F.col("n") - 1))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"),
    )
    score = F.when(F.col("size") == 1, F.lit(0.0)).otherwise(
        F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b"))
    )
    return per.select(F.col("id").alias(row_key), score.alias("silhouette"))
