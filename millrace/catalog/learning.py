"""L1-L7, L12, L20-L28 and E8. Learners differ from one engine to the next, so these have no SQL
check; ``tests/test_learners.py`` holds what must be true of them."""

from itertools import product

from pyspark.sql import functions as F

from millrace.catalog import standins as st
from millrace.catalog.registry import query
from millrace.functions.scalar import clip_negative, residual
from millrace.operators import centres, metrics, staged
from millrace.operators import learners as op
from millrace.operators.features import assembled, min_max, z_score
from millrace.operators.ranking import hash_split, stratified_folds, stratified_split
from millrace.operators.stats import category_counts
from millrace.session import written

# Penalty strengths of the search.
_STRENGTHS = (0.1, 0.01, 0.001, 0.0001)
_MEASURES = ["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice"]
_CREDIT = ["credit_limit", "sex", "education", "status", "age", "missed_payments", "avg_ba", "avg_pa"]


def priced_lines(t):
    """``row_id, label, features``: the price of a line from its quantity, rates and part."""
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    rows = lines.withColumn("row_id", F.xxhash64(*t.lineitem.columns)).withColumnRenamed("l_extendedprice", "label")
    return assembled(rows, _MEASURES).select("row_id", "label", "features")


def split_lines(t, weights=(0.8, 0.2)):
    parts = written(hash_split(priced_lines(t), "row_id", weights, seed=4), "lines")
    return [parts.where(F.col("part") == i).drop("part") for i in range(len(weights))]


def credit_rows(t):
    from millrace.plans.credit import cleaned

    rows = cleaned(st.clients(t)).withColumnRenamed("credit_default", "label")
    return assembled(rows, _CREDIT).select("client_id", F.col("label").cast("double").alias("label"), "features")


def split_credit(t):
    parts = written(stratified_split(credit_rows(t), "label", "client_id", 0.3, 42), "credit")
    return parts.where("is_test = 0").drop("is_test"), parts.where("is_test = 1").drop("is_test")


_FIGURES = ["credit_limit", "avg_ba", "avg_pa", "age"]


def client_figures(t, scale=z_score, suffix="_z"):
    """``client_id, features``: limit, mean bill, mean payment and age of every client, as z-scores by default."""
    from millrace.plans.credit import cleaned

    rows = written(cleaned(st.clients(t)).select("client_id", *_FIGURES), "figures")
    return assembled(scale(rows, _FIGURES), [f"{c}{suffix}" for c in _FIGURES]).select("client_id", "features")


@query("L1_linear_regression")
def _(t):
    train, valid = split_lines(t)
    models = {
        f"{p}:{s}": op.linear_regression(p, s)
        for p, s in [("none", 0.0), *product(("l1", "l2"), _STRENGTHS)]
    }
    return op.validation_sweep(train, valid, models)


@query("L2_decision_tree_regressor")
def _(t):
    train, valid = split_lines(t)
    (said,) = op.predicted(op.tree_regressor(22), train, [valid])
    scored = written(said.select("label", "prediction"), "scores")
    return metrics.log_errors(scored.withColumn("prediction", clip_negative("prediction")))


@query("L3_random_forest_regressor")
def _(t):
    train, valid = split_lines(t)
    (said,) = op.predicted(op.forest_regressor(22), train, [valid])
    scored = written(said.select("row_id", "label", "prediction"), "scores")
    return scored.withColumn("prediction", clip_negative("prediction")).select("row_id", residual("prediction", "label").alias("residual"))


@query("L4_decision_tree_classifier")
def _(t):
    train, test = split_credit(t)
    model = staged.SavedTrees(op.tree_classifier("gini", 4).fit(train), t.spark).collapsed(min_split=50)
    return metrics.class_report(op.scores(model, test, "label", "prediction"))


@query("L5_random_forest_classifier")
def _(t):
    train, test = split_credit(t)
    forest = op.forest_classifier(200, 5, 5).fit(op.dealt(train, 200))
    model = staged.SavedTrees(forest, t.spark).collapsed(min_split=50)
    return metrics.averaged_scores(op.scores(model, test, "label", "prediction"))


@query("L6_kmeans")
def _(t):
    return category_counts(centres.clustered(client_figures(t), 9, starts=10, iterations=100), "prediction")


@query("L7_kmeans_sweep")
def _(t):
    return centres.kmeans_sweep(client_figures(t), range(2, 51), starts=5, iterations=10)


@query("L12_nested_clusters")
def _(t):
    # Halving starts beside the middle of all rows, in proportion to its length, so that must not be zero.
    return op.nested_clusters(client_figures(t, min_max, "_sc"), "client_id", 4)


_SIZES = [10, 20, 30, 40, 50, 60, 70]
GRID = staged.tree_grid({
    "impurity": ["gini", "entropy"], "depth": [None, 2, 3, 4, 5], "min_split": [2, 5, *_SIZES], "min_leaf": [1, 5, *_SIZES],
})
DRAWN_FROM = staged.tree_grid({
    "depth": [None, *range(2, 20)], "min_split": [2, 5, 10, 20, 30, 50, 100], "min_leaf": [1, 5, 10, 20, 30, 50, 100],
})


def _search(t, grid):
    train, _ = split_credit(t)
    folded = written(stratified_folds(train, "label", "client_id", 3, 7), "folds")
    return staged.search_trees(folded, grid, "fold", 3)


@query("L20_grid_search")
def _(t):
    return _search(t, GRID)


@query("L21_random_search")
def _(t):
    return _search(t, staged.drawn(DRAWN_FROM, 100, seed=1))


@query("L22_cross_validation")
def _(t):
    train, _ = split_credit(t)
    folded = written(stratified_folds(train, "label", "client_id", 5, 7), "folds")
    tree = op.tree_classifier(depth=5)
    return op.cross_validate(folded, tree, [{}], op.f1_evaluator(), "fold", 5)[1]


def _depths(t):
    train, valid = split_lines(t)
    return staged.staged_sweep(train, valid, op.tree_regressor(), range(5, 27))


@query("L23_forest_validation_sweep")
def _(t):
    train, valid = split_lines(t)
    return staged.staged_sweep(train, valid, op.forest_regressor(trees=4), range(15, 22), name="forest_depth")


@query("L23_validation_sweep")
def _(t):
    return _depths(t).where("split = 'validation'")


@query("L24_best_parameters")
def _(t):
    return op.best_candidate(_depths(t))


@query("E8_train_and_validation_errors")
def _(t):
    return _depths(t)


@query("L25_predictions_on_held_out_rows")
def _(t):
    train, test = split_credit(t)
    return op.scores(op.tree_classifier(depth=5).fit(train), test, "client_id", "label", "prediction")


@query("L26_feature_importances")
def _(t):
    train, _ = split_credit(t)
    return op.importances(op.tree_classifier(depth=5).fit(train), _CREDIT, train)


@query("L27_tree_as_rules")
def _(t):
    train, _ = split_credit(t)
    text = op.tree_rules(op.tree_classifier(depth=4).fit(train), _CREDIT)
    return t.spark.createDataFrame(list(enumerate(text.split("\n"))), "line int, rule string")


@query("L28_random_baseline")
def _(t):
    _, test = split_credit(t)
    return metrics.class_report(op.random_baseline(test, "client_id", 2, 3))
