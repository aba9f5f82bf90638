"""What must hold for any learner, whatever numbers it gives."""

import pytest
from pyspark.sql import functions as F

from millrace.catalog import QUERIES
from millrace.operators import learners
from millrace.operators.features import assembled
from millrace.operators.ranking import stratified_folds

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def classed(spark):
    rows = spark.range(300).select(
        "id", (F.col("id") % 10).cast("double").alias("a"), F.pmod(F.xxhash64("id"), F.lit(7)).cast("double").alias("b")
    ).withColumn("label", (F.col("a") > 4).cast("double"))
    return assembled(rows, ["a", "b"]).cache()


def test_penalties(spark):
    assert learners.linear_regression("none", 5.0).getRegParam() == 0.0
    assert learners.linear_regression("l1", 0.1).getElasticNetParam() == 1.0
    with pytest.raises(ValueError):
        learners.linear_regression("l3")


def test_rows_of_a_large_forest_are_dealt_evenly(classed, monkeypatch):
    one = classed.coalesce(1)
    assert learners.dealt(one, 200) is one
    monkeypatch.setattr(learners, "TASK_WEIGHTS", 10_000)
    parts = learners.dealt(one, 200).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 6 and max(r["count"] for r in parts) <= 60
    assert learners.dealt(one, 200).exceptAll(one).isEmpty() and one.count() == 300


def test_depth_is_bounded():
    assert [learners.tree_depth(d) for d in (None, 30, 5)] == [30, 30, 5]
    with pytest.raises(ValueError):
        learners.tree_depth(110)


def test_importances_and_rules(classed):
    model = learners.tree_classifier(depth=4).fit(classed)
    table = {r.feature: r.importance for r in learners.importances(model, ["a", "b"], classed).collect()}
    assert sum(table.values()) == pytest.approx(1.0) and table["a"] > 0.99
    text = learners.tree_rules(model, ["a", "b"])
    assert "If (a <= " in text and "feature 0" not in text


def test_search_ranks_and_repeats(classed):
    folds = stratified_folds(classed, "label", "id", 3, 5)
    tree = learners.tree_classifier()
    grid = learners.param_grid(tree, {"maxDepth": [1, 3], "minInstancesPerNode": [1, 200]})
    best, table = learners.cross_validate(folds, tree, grid, learners.f1_evaluator(), "fold", 3)
    rows = table.orderBy("candidate").collect()
    assert rows[0]["rank"] == 1 and rows[0]["mean"] == pytest.approx(1.0)
    again = learners.cross_validate(folds, tree, grid, learners.f1_evaluator(), "fold", 3)[1]
    assert again.orderBy("candidate").collect() == rows
    assert learners.random_params(grid, 2, 1) == learners.random_params(grid, 2, 1)
    assert len(learners.random_params(grid, 99, 1)) == 4


def test_more_clusters_cost_less(classed):
    costs = [learners.kmeans_best(classed, k, starts=4).summary.trainingCost for k in (2, 4, 8)]
    assert costs == sorted(costs, reverse=True)


def test_sweep_table_and_best(classed):
    rows = classed.withColumn("label", F.col("a") + 1)
    table = learners.validation_sweep(rows, rows, {f"d{d}": learners.tree_regressor(d) for d in (1, 4)})
    assert table.count() == 4
    assert learners.best_candidate(table).first().params == "d4"


def test_baseline_is_even_and_stable(classed):
    drawn = learners.random_baseline(classed, "id", 3, 7)
    sizes = [r["count"] for r in drawn.groupBy("prediction").count().collect()]
    assert len(sizes) == 3 and min(sizes) > 70
    assert drawn.select("id", "prediction").collect() == learners.random_baseline(classed, "id", 3, 7).select("id", "prediction").collect()


@pytest.mark.parametrize("key", ["L12_nested_clusters", "L27_tree_as_rules", "energy_model_errors"])
def test_registered_models_run(spark, key):
    assert QUERIES[key](spark, FOLDER).count() > 0
