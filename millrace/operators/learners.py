"""Models and parameter search (L1-L7, L12, L20-L28) on ``spark.ml``."""

from __future__ import annotations

import math
import random
from collections.abc import Iterable, Mapping, Sequence
from itertools import product

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.clustering import BisectingKMeans, KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator, Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalar import clip_negative, hashed_class, squared_log_error
from millrace.operators.grown import outgrows_driver, staged_in_tasks
from millrace.session import scratch_path, written

# The deepest tree the learner accepts; a missing depth means this one.
DEEPEST = 30
#: Weights that a task of a forest's fit holds: one per row and tree.
TASK_WEIGHTS = 8_000_000
PENALTIES = {"none": 0.0, "l1": 1.0, "l2": 0.0}


def tree_depth(depth: int | None) -> int:
    if depth is not None and depth > DEEPEST:
        raise ValueError(f"the deepest tree is {DEEPEST}, not {depth}; None asks for that one")
    return DEEPEST if depth is None else depth


def linear_regression(penalty: str = "none", strength: float = 0.0, **params) -> LinearRegression:
    if penalty not in PENALTIES:
        raise ValueError(f"penalty must be one of {sorted(PENALTIES)}, not {penalty!r}")
    return LinearRegression(
        elasticNetParam=PENALTIES[penalty], regParam=0.0 if penalty == "none" else strength, **params
    )


def tree_regressor(depth: int | None = 5, bins: int = 32, **params) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(maxDepth=tree_depth(depth), maxBins=bins, seed=4, **params)


def forest_regressor(depth: int | None = 15, trees: int = 4, bins: int = 32, seed: int = 4, **params):
    return RandomForestRegressor(
        maxDepth=tree_depth(depth), numTrees=trees, maxBins=bins, seed=seed, **params
    )


def tree_classifier(
    impurity: str = "gini", depth: int | None = None, min_leaf: int = 1, seed: int = 0, **params
) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(
        impurity=impurity, maxDepth=tree_depth(depth), minInstancesPerNode=min_leaf, seed=seed, **params
    )


def forest_classifier(
    trees: int = 20, depth: int | None = None, min_leaf: int = 1, subset: str = "auto",
    bootstrap: bool = True, seed: int = 0, **params,
) -> RandomForestClassifier:
    return RandomForestClassifier(
        numTrees=trees, maxDepth=tree_depth(depth), minInstancesPerNode=min_leaf,
        featureSubsetStrategy=subset, bootstrap=bootstrap, seed=seed, **params,
    )


class kept:
    """Rows that several jobs of one search read, held on the executors' disks and memory."""

    def __init__(self, *tables: DataFrame):
        self.tables = tables

    def __enter__(self):
        for t in self.tables:
            t.persist(StorageLevel.MEMORY_AND_DISK)
        return self.tables if len(self.tables) > 1 else self.tables[0]

    def __exit__(self, *exc):
        for t in self.tables:
            t.unpersist()


def dealt(train: DataFrame, trees: int) -> DataFrame:
    """``train`` in as many equal partitions as a forest of ``trees`` needs, so that no task holds and reads all weights.

    Rows that one task can take stay as they are.
    """
    parts = math.ceil(train.count() * trees / TASK_WEIGHTS)
    return train.repartition(parts) if parts > 1 else train


def scores(model: Model, df: DataFrame, *cols: str) -> DataFrame:
    """``cols`` of the scored rows, stored once, so that later steps do not predict again."""
    return written(portable(model, df).transform(df).select(*cols), "scores")


def predicted(estimator: Estimator, train: DataFrame, tables: Sequence[DataFrame]) -> list[DataFrame]:
    """``tables`` with the ``prediction`` of ``estimator`` fitted to ``train``; of a deep tree on many rows without a model."""
    if not outgrows_driver(train, estimator):
        model = estimator.fit(train)
        return [portable(model, t).transform(t) for t in tables]
    features = estimator.getFeaturesCol()
    slim = [t.drop(*[f.name for f in t.schema if f.dataType.typeName() == "vectorudt" and f.name != features]) for t in tables]
    said = staged_in_tasks(train, slim, estimator, [estimator.getMaxDepth()])
    return [t.withColumn("prediction", F.get("staged", F.lit(0))).drop("staged") for t in said]


def portable(model: Model, df: DataFrame) -> Model:
    """The model as saved and loaded again.

    A model fresh from ``fit`` holds its session through its summary, and where it lands in a filter that is
    sent to the tasks it can't be serialised.
    """
    path = scratch_path(df.sparkSession, "model")
    model.write().save(path)
    return type(model).load(path)


# --- clustering --------------------------------------------------------------------------


def kmeans_best(df: DataFrame, k: int, starts: int = 10, iterations: int = 100, seed: int = 0) -> KMeansModel:
    """The model with the lowest squared error over several seeded starts."""
    with kept(df) as rows:
        models = [
            KMeans(k=k, maxIter=iterations, seed=seed + i).fit(rows) for i in range(starts)
        ]
    return min(models, key=lambda m: m.summary.trainingCost)


def k_sweep(
    df: DataFrame, ks: Iterable[int], starts: int = 1, iterations: int = 100, seed: int = 0
) -> DataFrame:
    """``k, sse, silhouette`` per number of clusters."""
    rows = []
    with kept(df) as points:
        for k in ks:
            models = [KMeans(k=k, maxIter=iterations, seed=seed + i).fit(points) for i in range(starts)]
            best = min(models, key=lambda m: m.summary.trainingCost)
            score = ClusteringEvaluator().evaluate(best.transform(points))
            rows.append((int(k), float(best.summary.trainingCost), float(score)))
    return df.sparkSession.createDataFrame(rows, "k int, sse double, silhouette double")


def nested_clusters(df: DataFrame, row_key: str, k: int, seed: int = 0) -> DataFrame:
    """``row_key, prediction``: hierarchical groups by repeated halving, usable where linkage on
    all pairs is not."""
    return scores(BisectingKMeans(k=k, seed=seed).fit(df), df, row_key, "prediction")


# --- search ------------------------------------------------------------------------------


def param_grid(estimator: Estimator, values: Mapping[str, Sequence]) -> list[dict]:
    names = list(values)
    return [
        {estimator.getParam(n): v for n, v in zip(names, combo)} for combo in product(*values.values())
    ]


def random_params(grid: Sequence[dict], n: int, seed: int) -> list[dict]:
    return random.Random(seed).sample(list(grid), min(n, len(grid)))


def cross_validate(
    df: DataFrame, estimator: Estimator, grid: Sequence[dict], evaluator: Evaluator,
    fold: str, folds: int, parallelism: int = 2,
) -> tuple[Model, DataFrame]:
    """Best model and ``candidate, params, mean, spread, rank``; folds come from a column.

    ``spread`` is twice the standard deviation over the folds.
    """
    search = CrossValidator(
        estimator=estimator, estimatorParamMaps=list(grid), evaluator=evaluator, numFolds=folds,
        foldCol=fold, parallelism=parallelism,
    )
    with kept(df) as rows:
        model = search.fit(rows)
    better = 1 if evaluator.isLargerBetter() else -1
    means = [float(m) for m in model.avgMetrics]
    rows = [
        (
            i, ", ".join(f"{p.name}={v}" for p, v in sorted(g.items(), key=lambda e: e[0].name)),
            m, float(2 * s), 1 + sum(better * o > better * m for o in means),
        )
        for i, (g, m, s) in enumerate(zip(grid, means, model.stdMetrics))
    ]
    table = df.sparkSession.createDataFrame(
        rows, "candidate int, params string, mean double, spread double, rank int"
    )
    return model.bestModel, table


def f1_evaluator(label: str = "label") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, metricName="f1")


def validation_sweep(
    train: DataFrame, valid: DataFrame, candidates: Mapping[str, Estimator], label: str = "label"
) -> DataFrame:
    """``params, split, msle``: mean squared log error of each candidate on both splits.

    Predictions below zero count as zero. A candidate that fails raises.
    """
    rows = []
    with kept(train, valid) as (fit_on, check_on):
        for name, estimator in candidates.items():
            for split, data in zip(("train", "validation"), predicted(estimator, fit_on, (fit_on, check_on))):
                scored = data.withColumn("prediction", clip_negative("prediction"))
                error = scored.agg(F.avg(squared_log_error(label, "prediction"))).first()[0]
                rows.append((name, split, float(error)))
    return train.sparkSession.createDataFrame(rows, "params string, split string, msle double")


def best_candidate(errors: DataFrame, split: str = "validation", error: str = "msle") -> DataFrame:
    return errors.where(F.col("split") == split).orderBy(error, "params").limit(1)


# --- reading models ----------------------------------------------------------------------


def importances(model: Model, names: Sequence[str], df: DataFrame) -> DataFrame:
    """``feature, importance``; the importances add up to 1."""
    values = model.featureImportances.toArray()
    return df.sparkSession.createDataFrame(
        [(n, float(v)) for n, v in zip(names, values)], "feature string, importance double"
    )


def tree_rules(model: Model, names: Sequence[str]) -> str:
    """The tree as nested conditions with feature names in place of numbers."""
    text = model.toDebugString
    for i in sorted(range(len(names)), reverse=True):
        text = text.replace(f"feature {i} ", f"{names[i]} ")
    return text


def random_baseline(df: DataFrame, row_key: str, classes: int, seed: int) -> DataFrame:
    """Predictions drawn uniformly by row key, the floor any classifier has to beat."""
    return df.withColumn("prediction", hashed_class(row_key, classes, seed).cast("double"))


def fitted(stages: Sequence[Estimator], df: DataFrame) -> Model:
    return Pipeline(stages=list(stages)).fit(df)
