"""Cut trees against trees fitted or grown to that size, and the search over them against one fit per candidate."""

import random

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from millrace.operators import staged
from millrace.operators.features import assembled
from millrace.operators.ranking import stratified_folds


def made(n=500, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.randrange(12), rng.randrange(9), rng.randrange(15)
        noise = rng.random()
        label = float((a > 6) ^ (b > 4 and c < 8)) if noise < 0.85 else float(rng.randrange(2))
        rows.append((i, float(a), float(b), float(c), label, a * 3 + b * b - c + 5 * noise + 20))
    return rows


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame(made(), "id long, a double, b double, c double, label double, value double")
    return assembled(df, ["a", "b", "c"]).cache()


def said(model, rows):
    return {r["id"]: r["prediction"] for r in model.transform(rows).select("id", "prediction").collect()}


@pytest.mark.parametrize("depth", [1, 3, 6])
@pytest.mark.parametrize("kind", [DecisionTreeRegressor, RandomForestRegressor])
def test_a_cut_regressor_is_one_fitted_to_that_depth(rows, kind, depth):
    extra = {"featureSubsetStrategy": "all", "numTrees": 4} if kind is RandomForestRegressor else {}
    deep = kind(labelCol="value", maxDepth=12, seed=4, **extra).fit(rows)
    flat = said(kind(labelCol="value", maxDepth=depth, seed=4, **extra).fit(rows), rows)
    staged_rows = staged.staged_predictions(rows.select("id", "features"), deep, [depth, 12]).collect()
    assert {r["id"]: r["staged"][0] for r in staged_rows} == pytest.approx(flat)
    assert {r["id"]: r["staged"][1] for r in staged_rows} == pytest.approx(said(deep, rows))
    assert said(staged.SavedTrees(deep, rows.sparkSession).collapsed(depth), rows) == pytest.approx(flat)


@pytest.mark.parametrize("depth", [1, 3, 6])
@pytest.mark.parametrize("kind", [DecisionTreeClassifier, RandomForestClassifier])
def test_a_cut_classifier_is_one_fitted_to_that_depth(rows, kind, depth):
    extra = {"featureSubsetStrategy": "all", "numTrees": 5} if kind is RandomForestClassifier else {}
    deep = kind(maxDepth=12, seed=4, **extra).fit(rows)
    flat = kind(maxDepth=depth, seed=4, **extra).fit(rows)
    cut = staged.SavedTrees(deep, rows.sparkSession).collapsed(depth)
    votes = lambda m: {r["id"]: list(r["probability"]) for r in m.transform(rows).collect()}
    left, right = votes(cut), votes(flat)
    assert all(left[i] == pytest.approx(right[i]) for i in right)
    assert cut.totalNumNodes == flat.totalNumNodes if extra else cut.numNodes == flat.numNodes


def gini(labels):
    return 1 - sum((labels.count(v) / len(labels)) ** 2 for v in set(labels))


def grow(rows, depth, min_split, min_leaf):
    """A plain recursive tree: (feature, cut, left, right) or the label most rows have."""
    labels = [r[-1] for r in rows]
    most = max(sorted(set(labels)), key=labels.count)
    best = None
    if depth and len(rows) >= min_split:
        for f in range(3):
            values = sorted({r[f] for r in rows})
            for low, high in zip(values, values[1:]):
                sides = [r for r in rows if r[f] <= low], [r for r in rows if r[f] > low]
                if min(map(len, sides)) < min_leaf:
                    continue
                gain = gini(labels) - sum(len(s) / len(rows) * gini([r[-1] for r in s]) for s in sides)
                if gain > 1e-12 and (best is None or gain > best[0] + 1e-12):
                    best = gain, f, (low + high) / 2, sides
    if best is None:
        return most
    return best[1], best[2], *[grow(s, depth - 1, min_split, min_leaf) for s in best[3]]


def walk(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


@pytest.mark.parametrize(("depth", "min_split", "min_leaf"), [(7, 60, 1), (7, 25, 5), (4, 100, 3), (7, 2, 1), (7, 501, 1)])
def test_smallest_split_against_a_plain_tree(rows, depth, min_split, min_leaf):
    deep = DecisionTreeClassifier(maxDepth=10, minInstancesPerNode=min_leaf, seed=1).fit(rows)
    cut = staged.SavedTrees(deep, rows.sparkSession).collapsed(depth, min_split)
    plain = [(a, b, c, label) for _, a, b, c, label, _ in made()]
    tree = grow(plain, depth, min_split, min_leaf)
    assert said(cut, rows) == {i: walk(tree, r) for i, r in enumerate(plain)}


def test_search_is_a_fit_per_candidate(rows):
    folded = stratified_folds(rows, "label", "id", 3, 5).cache()
    grid = staged.tree_grid({"impurity": ["gini", "entropy"], "depth": [2, 5, None], "min_split": [2, 40], "min_leaf": [1, 15]})
    found = {r["params"]: r for r in staged.search_trees(folded, grid, "fold", 3).collect()}
    assert len(found) == 24 and min(r["rank"] for r in found.values()) == 1
    for c in random.Random(2).sample(grid, 6):
        shares = []
        for k in range(3):
            fit_on, check_on = folded.where(F.col("fold") != k), folded.where(F.col("fold") == k)
            model = DecisionTreeClassifier(impurity=c["impurity"], maxDepth=c["depth"] or 30, minInstancesPerNode=c["min_leaf"], seed=0).fit(fit_on)
            model = staged.SavedTrees(model, rows.sparkSession).collapsed(min_split=c["min_split"])
            shares.append(model.transform(check_on).agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0])
        row = found[", ".join(f"{k}={v}" for k, v in sorted(c.items()))]
        assert row["mean"] == pytest.approx(sum(shares) / 3)


def test_a_search_keeps_no_rows_of_nodes(rows, monkeypatch):
    """Each of the many deep trees was held as a dictionary per node until the last one was fitted."""
    def refuse(*_):
        raise AssertionError("nodes as rows")

    monkeypatch.setattr(staged, "SavedTrees", refuse)
    folded = stratified_folds(rows, "label", "id", 3, 5).cache()
    assert staged.search_trees(folded, staged.tree_grid({"depth": [2, None], "min_split": [2, 40]}), "fold", 3).count() == 4


@pytest.mark.parametrize(("depth", "min_split"), [(None, 2), (3, 2), (None, 40), (5, 25), (0, 2)])
def test_node_columns_cut_as_saved_trees_do(rows, depth, min_split):
    deep = DecisionTreeClassifier(maxDepth=12, seed=4).fit(rows)
    (tree,), columns = staged.SavedTrees(deep, rows.sparkSession).trees, staged.NodeColumns.of(deep, rows.sparkSession)
    want = [tree.nodes[tree.stop(tree.path(leaf), depth, min_split)]["prediction"] for leaf in tree.leaves()]
    assert columns.says(columns.levels(), depth, min_split).tolist() == want


def test_sweep_is_a_fit_per_depth(rows):
    train, valid = rows.where("id % 4 <> 0"), rows.where("id % 4 = 0")
    sweep = staged.staged_sweep(train, valid, DecisionTreeRegressor(labelCol="value", seed=4), [2, 4, 7], label="value").collect()
    from millrace.operators.learners import validation_sweep

    plain = validation_sweep(train, valid, {f"depth={d:02d}": DecisionTreeRegressor(labelCol="value", seed=4, maxDepth=d) for d in (2, 4, 7)}, "value").collect()
    assert {(r.params, r.split): r.msle for r in sweep} == pytest.approx({(r.params, r.split): r.msle for r in plain})


def test_grids():
    grid = staged.tree_grid({"depth": [None, 3], "min_leaf": [1, 2, 3]})
    assert len(grid) == 6 and grid[0] == {"impurity": "gini", "depth": None, "min_split": 2, "min_leaf": 1}
    assert staged.drawn(grid, 4, 1) == staged.drawn(grid, 4, 1) and len(staged.drawn(grid, 99, 1)) == 6
    with pytest.raises(ValueError):
        staged.tree_grid({"max_depth": [1]})
