"""Registered queries without a SQL check: each run on the tables, and what must hold of its rows."""

from collections import Counter

import pytest

from millrace.catalog import CHECKS, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def run(spark):
    done = {}

    def of(key):
        if key not in done:
            done[key] = QUERIES[key](spark, FOLDER).collect()
        return done[key]

    return of


def keys(spark, table, column):
    return {r[0] for r in spark.read.parquet(f"{FOLDER}/{table}.parquet").select(column).collect()}


def test_sample(spark, run):
    rows = run("T4_random_sample")
    ids = {r.c_custkey for r in rows}
    assert len(rows) == len(ids) == 10 and ids <= keys(spark, "customer", "c_custkey")
    assert ids == {r.c_custkey for r in QUERIES["T4_random_sample"](spark, FOLDER).collect()}


def test_split_covers_all_rows(spark, run):
    sizes = {r.part: r.n for r in run("T5_random_split")}
    total = len(keys(spark, "orders", "o_orderkey"))
    assert sum(sizes.values()) == total and abs(sizes[0] / total - 0.8) < 0.05


def test_random_classes_are_even(spark, run):
    rows = run("X26_random_class")
    sizes = Counter(r.random_class for r in rows)
    assert {r.o_orderkey for r in rows} == keys(spark, "orders", "o_orderkey")
    assert set(sizes) == {0, 1, 2} and min(sizes.values()) > 0.28 * len(rows)


def test_linear_candidates(run):
    errors = {(r.params, r.split): r.msle for r in run("L1_linear_regression")}
    names = {p for p, _ in errors}
    assert len(names) == 9 and len(errors) == 18
    # A stronger penalty fits the training rows no better.
    for kind in ("l1", "l2"):
        assert errors[f"{kind}:0.0001", "train"] <= errors[f"{kind}:0.1", "train"] * 1.001


def test_regressors(run):
    errors = run("L2_decision_tree_regressor")
    assert len(errors) == 1 and min(errors[0]) > 0
    rows = run("L3_random_forest_regressor")
    assert len(rows) == len({r.row_id for r in rows}) > 500


@pytest.mark.parametrize("key", ["L4_decision_tree_classifier", "credit_forest_scores", "L28_random_baseline", "talks_tree_report"])
def test_class_reports_are_shares(run, key):
    rows = run(key)
    assert len(rows) >= 2 and all(0 <= v <= 1 for r in rows for v in (r.precision, r.recall, r.f1))


def test_forest_classifier(run):
    assert all(0 <= v <= 1 for r in run("L5_random_forest_classifier") for v in r if isinstance(v, float))


def test_clusters_hold_every_client(spark, run):
    clients = len(keys(spark, "customer", "c_custkey"))
    rows = run("L6_kmeans")
    assert len(rows) <= 9 and sum(r.n for r in rows) == clients
    nested = run("L12_nested_clusters")
    assert len(nested) == clients and len({r.prediction for r in nested}) == 4


def test_more_clusters_have_less_error(run):
    costs = [r.sse for r in sorted(run("L7_kmeans_sweep"), key=lambda r: r.k)]
    assert costs[0] == max(costs) and costs[-1] == min(costs)


def test_search_tables(run):
    for key, n in (("L20_grid_search", 810), ("L21_random_search", 100), ("L22_cross_validation", 1)):
        rows = run(key)
        assert len(rows) == n and min(r["rank"] for r in rows) == 1
        assert max(rows, key=lambda r: r["mean"])["rank"] == 1 and all(0 <= r["mean"] <= 1 for r in rows)


def test_sweep_and_its_best(run):
    errors = run("E8_train_and_validation_errors")
    validation = {r.params: r.msle for r in errors if r.split == "validation"}
    assert {r.params: r.msle for r in run("L23_validation_sweep")} == pytest.approx(validation)
    assert run("L24_best_parameters")[0].params == min(validation, key=lambda p: (validation[p], p))
    train = [r.msle for r in sorted(errors, key=lambda r: r.params) if r.split == "train"]
    assert train == sorted(train, reverse=True)  # deeper trees fit the training rows better


def test_forest_sweep(run):
    rows = run("L23_forest_validation_sweep")
    assert Counter(r.params for r in rows) == {f"forest_depth={d}": 2 for d in range(15, 22)} and min(r.msle for r in rows) > 0


def test_held_out_predictions(run):
    rows = run("L25_predictions_on_held_out_rows")
    assert rows and len({r.client_id for r in rows}) == len(rows) and {r.prediction for r in rows} <= {0.0, 1.0}


def test_importances_add_up(run):
    values = [r.importance for r in run("L26_feature_importances")]
    assert sum(values) == pytest.approx(1.0) and min(values) >= 0


def test_rules_name_features(run):
    text = "\n".join(r.rule for r in run("L27_tree_as_rules"))
    assert "If (" in text and "Predict:" in text and "feature 0 " not in text


@pytest.mark.parametrize("key", ["L9_density_sweep_by_cells", "L11_single_link_k_by_cells", "L16_rules_of_client_rows", "energy_model_errors"])
def test_gives_rows(run, key):
    assert run(key)


def test_every_query_without_sql_is_here():
    text = open(__file__).read()
    assert not [key for key in QUERIES if key not in CHECKS and key not in text]
