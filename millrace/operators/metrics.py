"""Evaluation from a (label, prediction) table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.scalar import squared_log_error
from millrace.operators.ordered import HOT_ROWS, running_before


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(df: DataFrame, classes: Sequence, label: str = "label", prediction: str = "prediction") -> DataFrame:
    cells = [F.count_if(F.col(prediction) == F.lit(c)).alias(f"predicted_{c}") for c in classes]
    return df.groupBy(F.col(label).alias("label")).agg(*cells)


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    hit = (F.col(label) == F.col(prediction)).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"))


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``class, precision, recall, f1, support``; a division by zero counts as 0.

    The rows are counted once into the confusion counts; everything else works on those.
    """
    counts = confusion_counts(df, label, prediction)
    sides = counts.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("label").alias("class"), F.col("n").alias("support"),
                    F.lit(0).cast("bigint").alias("called"),
                    F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hits"),
                ),
                F.struct(
                    F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("support"),
                    F.col("n").alias("called"), F.lit(0).cast("bigint").alias("hits"),
                ),
            )
        )
    )
    per = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "called", "hits")])
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide(F.col("hits").cast("double"), F.col("called")), zero)
    recall = F.coalesce(F.try_divide(F.col("hits").cast("double"), F.col("support")), zero)
    f1 = F.coalesce(F.try_divide(2.0 * F.col("hits"), F.col("called") + F.col("support")), zero)
    return per.select(
        "class", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support"
    )


def averaged_scores(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``average, precision, recall, f1`` for micro, macro and support-weighted averages."""
    report = class_report(df, label, prediction)
    share = F.col("support") / F.sum("support").over(W.partitionBy())
    sums = report.withColumn("share", share).agg(
        *[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")],
        *[F.sum(F.col(c) * F.col("share")).alias(f"weighted_{c}") for c in ("precision", "recall", "f1")],
        (F.sum(F.col("recall") * F.col("share"))).alias("micro"),
    )
    cells = [
        F.struct(
            F.lit(kind).alias("average"),
            *[
                (F.col("micro") if kind == "micro" else F.col(f"{kind}_{c}")).alias(c)
                for c in ("precision", "recall", "f1")
            ],
        )
        for kind in ("micro", "macro", "weighted")
    ]
    return sums.select(F.inline(F.array(*cells)))


def roc_points(df: DataFrame, label: str, score: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``threshold, fpr, tpr``, one point per distinct score; rows of equal score are one step."""
    steps = df.groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    totals = df.agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    run = running_before(steps, [], "threshold", ["pos", "neg"], descending=True, hot_rows=hot_rows)
    rate = lambda c: F.try_divide(
        (F.col(f"{c}_before") + F.col(c)).cast("double"), totals.select(c).scalar()
    )
    before = lambda c: F.try_divide(
        F.col(f"{c}_before").cast("double"), totals.select(c).scalar()
    )
    return run.select(
        "threshold", rate("neg").alias("fpr"), rate("pos").alias("tpr"),
        before("neg").alias("fpr_before"), before("pos").alias("tpr_before"),
    )


def roc_auc(df: DataFrame, label: str, score: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Area under the ROC points by trapezoids."""
    points = roc_points(df, label, score, hot_rows)
    area = (F.col("fpr") - F.col("fpr_before")) * (F.col("tpr") + F.col("tpr_before")) / 2.0
    return points.agg(F.sum(area).alias("auc"))


def log_errors(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Mean squared log error and its root; predictions are expected to be clipped at 0."""
    mean = F.avg(squared_log_error(label, prediction))
    return df.agg(mean.alias("msle"), F.sqrt(mean).alias("rmsle"))
