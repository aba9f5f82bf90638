"""Trees cut after they were fitted: one deep fit answers for every depth and every minimum split size.

How a node is split depends neither on the depth a tree may reach nor on the fewest rows a node needs to be split. So the
tree of a smaller depth, or of a larger split size, is the deep one with some nodes turned into leaves. ``SavedTrees``
reads the nodes of a model as Spark saves them; a node table is as large as the model, which the driver and every task
hold anyway. Rows are never walked through a tree here: the model's own leaf index tells where each ended, and what follows
is a matter of leaves.

A forest that draws features per node draws others when it is fitted to another depth; its cut is one of the forests
that depth may give, not the same one. With all features in every node, the cut and the fit are equal.
"""

from __future__ import annotations

import random
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from itertools import product
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.scalar import clip_negative, squared_log_error
from millrace.operators.grown import outgrows_driver, staged_in_tasks
from millrace.operators.learners import DEEPEST, kept, tree_classifier
from millrace.operators.searched import outgrows_models, tables_of_search
from millrace.session import scratch_path

#: Models that are fitted side by side, and with more rows than ``MANY_ROWS``, when each may hold as many nodes.
SIDE_BY_SIDE, FEWER, MANY_ROWS = 8, 3, 100_000


@dataclass
class SavedTree:
    """The nodes of one tree in preorder, as plain rows of Spark's saved form."""

    nodes: list[dict]

    def __post_init__(self):
        self.nodes = sorted(self.nodes, key=lambda n: n["id"])
        self.depth = [0] * len(self.nodes)
        self.parent = [-1] * len(self.nodes)
        for n in self.nodes:
            for child in (n["leftChild"], n["rightChild"]):
                if child >= 0:
                    self.depth[child], self.parent[child] = self.depth[n["id"]] + 1, n["id"]

    def leaves(self) -> list[int]:
        """Node numbers of the leaves, in the order of the model's leaf index."""
        return [n["id"] for n in self.nodes if n["leftChild"] < 0]

    def path(self, node: int) -> list[int]:
        """Nodes from the root to ``node``."""
        out = [node]
        while self.parent[out[-1]] >= 0:
            out.append(self.parent[out[-1]])
        return out[::-1]

    def staged(self, depths: Sequence[int]) -> list[list[float]]:
        """For each leaf, the prediction of the tree cut at each depth."""
        out = []
        for leaf in self.leaves():
            path = self.path(leaf)
            out.append([self.nodes[path[min(d, len(path) - 1)]]["prediction"] for d in depths])
        return out

    def stop(self, path: list[int], depth: int | None, min_split: int) -> int:
        """The node of ``path`` that is a leaf once nodes at ``depth`` or with fewer rows than ``min_split`` are."""
        for level, node in enumerate(path):
            if level == depth or self.nodes[node]["rawCount"] < min_split:
                return node
        return path[-1]

    def collapsed(self, depth: int | None, min_split: int, merge: bool) -> list[dict]:
        """The nodes of the cut tree, numbered anew; ``merge`` turns a node whose two leaves say the same into a leaf."""
        closed = {
            n["id"] for n in self.nodes
            if n["leftChild"] < 0 or self.depth[n["id"]] == depth or n["rawCount"] < min_split
        }
        if merge:
            # Children have higher numbers than their parent.
            for n in reversed(self.nodes):
                sides = (n["leftChild"], n["rightChild"])
                if n["id"] not in closed and all(s in closed for s in sides):
                    if self.nodes[sides[0]]["prediction"] == self.nodes[sides[1]]["prediction"]:
                        closed.add(n["id"])
        out, waiting = [], [(0, None, "")]
        while waiting:
            at, above, side = waiting.pop()
            node = dict(self.nodes[at], id=len(out))
            if above is not None:
                above[side] = node["id"]
            if at in closed:
                node |= {"leftChild": -1, "rightChild": -1, "gain": -1.0}
                node["split"] = {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}
            else:
                waiting += [(node["rightChild"], node, "rightChild"), (node["leftChild"], node, "leftChild")]
            out.append(node)
        return out


class SavedTrees:
    """A tree or forest model as saved: its nodes, and models of the cut trees."""

    def __init__(self, model: Model, spark: SparkSession):
        self.spark, self.kind = spark, type(model)
        self.folder = scratch_path(spark, "trees")
        model.write().save(self.folder)
        self.data = spark.read.parquet(f"{self.folder}/data")
        self.forest = "treeID" in self.data.columns
        trees: dict[int, list[dict]] = {}
        for row in self.data.collect():  # as many rows as the model has nodes
            plain = row.asDict(recursive=True)
            trees.setdefault(plain.get("treeID", 0), []).append(plain.get("nodeData", plain))
        self.trees = [SavedTree(trees[k]) for k in sorted(trees)]
        self.classes = "Classif" in self.kind.__name__

    def collapsed(self, depth: int | None = None, min_split: int = 2) -> Model:
        """A model of its own, cut at ``depth`` and where a node holds fewer rows than ``min_split``.

        A forest counts a row as often as a tree has drawn it. Spark's classifiers merge leaves that say the same, and so does this.
        """
        rows = []
        for k, tree in enumerate(self.trees):
            for node in tree.collapsed(depth, min_split, merge=self.classes):
                rows.append({"treeID": k, "nodeData": node} if self.forest else node)
        folder = scratch_path(self.spark, "trees")
        self.kind.load(self.folder).write().save(folder)
        self.spark.createDataFrame(rows, self.data.schema).write.mode("overwrite").parquet(f"{folder}/data")
        return self.kind.load(folder)


def _leaf_numbers(scored: DataFrame, trees: int) -> list[Column]:
    if trees == 1 and dict(scored.dtypes)["leaf"] == "double":
        return [F.col("leaf").cast("int")]
    return [F.get(vector_to_array("leaf"), F.lit(k)).cast("int") for k in range(trees)]


def staged_predictions(rows: DataFrame, model: Model, depths: Sequence[int], out: str = "staged") -> DataFrame:
    """``rows`` with the array ``out``: what the regression ``model``, cut at each of ``depths``, says of them.

    The leaf of each row is looked up in a table of its leaves' paths, as large as the model times ``depths``.
    """
    saved = SavedTrees(model, rows.sparkSession)
    scored = model.copy({model.leafCol: "leaf"}).transform(rows)
    scored = scored.select(*rows.columns, *[n.alias(f"leaf_{k}") for k, n in enumerate(_leaf_numbers(scored, len(saved.trees)))])
    for k, tree in enumerate(saved.trees):
        table = [(i, values) for i, values in enumerate(tree.staged(depths))]
        paths = rows.sparkSession.createDataFrame(table, f"leaf_{k} int, said_{k} array<double>")
        scored = scored.join(paths, f"leaf_{k}").drop(f"leaf_{k}")
    said = [F.col(f"said_{k}") for k in range(len(saved.trees))]
    total = said[0]
    for more in said[1:]:
        total = F.zip_with(total, more, lambda a, b: a + b)
    return scored.select(*rows.columns, F.transform(total, lambda v: v / len(said)).alias(out))


def staged_sweep(
    train: DataFrame, valid: DataFrame, estimator: Estimator, depths: Iterable[int], label: str = "label", name: str = "depth"
) -> DataFrame:
    """``params, split, msle`` of every depth on both splits, from one fit at the largest depth and one pass over each split."""
    depths = sorted(depths)
    out = []
    deep = estimator.copy({estimator.maxDepth: depths[-1]})
    with kept(train, valid) as (fit_on, check_on):
        slim = [t.select(label, "features") for t in (fit_on, check_on)]
        if outgrows_driver(fit_on, deep):
            said = staged_in_tasks(fit_on, slim, deep, depths)
        else:
            model = deep.fit(fit_on)
            said = [staged_predictions(t, model, depths) for t in slim]
        for split, staged in zip(("train", "validation"), said):
            errors = staged.agg(*[
                F.avg(squared_log_error(label, clip_negative(F.get("staged", F.lit(i))))).alias(str(d)) for i, d in enumerate(depths)
            ]).first()
            out += [(f"{name}={d:02d}", split, float(errors[str(d)])) for d in depths]
    return train.sparkSession.createDataFrame(out, "params string, split string, msle double")


# --- search over trees -------------------------------------------------------------------


def tree_grid(values: Mapping[str, Sequence]) -> list[dict]:
    """All candidates of ``impurity, depth, min_split, min_leaf``; what ``values`` leaves out takes its usual value."""
    usual = {"impurity": ["gini"], "depth": [None], "min_split": [2], "min_leaf": [1]}
    if set(values) - set(usual):
        raise ValueError(f"a tree has {sorted(usual)}, not {sorted(set(values) - set(usual))}")
    dims = usual | {k: list(v) for k, v in values.items()}
    return [dict(zip(dims, combo)) for combo in product(*dims.values())]


def drawn(grid: Sequence[dict], n: int, seed: int) -> list[dict]:
    return random.Random(seed).sample(list(grid), min(n, len(grid)))


@dataclass
class NodeColumns:
    """The nodes of one saved decision tree as columns, by node number: about 30 bytes each."""

    left: np.ndarray
    right: np.ndarray
    said: np.ndarray
    count: np.ndarray

    @staticmethod
    def of(model: Model, spark: SparkSession) -> NodeColumns:
        folder = scratch_path(spark, "trees")
        model.write().save(folder)
        names = ["leftChild", "rightChild", "prediction", "rawCount"]
        table = spark.read.parquet(f"{folder}/data").select("id", *names).toArrow().sort_by("id")  # as many rows as nodes
        return NodeColumns(*[table[c].to_numpy() for c in names])

    def levels(self) -> list[np.ndarray]:
        """Node numbers by depth."""
        out = [np.zeros(1, np.int64)]
        while len(inner := out[-1][self.left[out[-1]] >= 0]):
            out.append(np.concatenate([self.left[inner], self.right[inner]]))
        return out

    def says(self, levels: list[np.ndarray], depth: int | None, min_split: int) -> np.ndarray:
        """For each leaf, the class that the tree cut at ``depth`` and below ``min_split`` rows says."""
        answer = np.arange(len(self.left))
        closed = (self.left < 0) | (self.count < min_split)
        for level, nodes in enumerate(levels):
            if level == depth:
                closed[nodes] = True
            shut, open_ = nodes[closed[nodes]], nodes[~closed[nodes]]
            for side in (self.left, self.right):
                under, above = side[shut], shut[side[shut] >= 0]
                under = under[under >= 0]
                answer[under], closed[under] = answer[above], True
                answer[side[open_]] = side[open_]
        return self.said[answer[self.left < 0]].astype(np.int64)


def _confusion(
    tree: NodeColumns, levels: list[np.ndarray], leaf: np.ndarray, label: np.ndarray, n: np.ndarray, candidate: dict, classes: int
) -> np.ndarray:
    """Rows by label and by what the cut tree says, from the rows ``n`` per ``leaf`` and ``label`` of the deep one."""
    says = tree.says(levels, candidate["depth"], candidate["min_split"])
    return np.bincount(label * classes + says[leaf], n, classes * classes).astype(np.int64).reshape(classes, classes)


def _accuracy(table: np.ndarray) -> float:
    return float(np.trace(table) / max(table.sum(), 1))


def _f1(table: np.ndarray) -> float:
    """F1 of the classes, weighted by their rows."""
    hit, said, held = np.diag(table), table.sum(0), table.sum(1)
    return float((held * np.divide(2 * hit, said + held, out=np.zeros(len(hit)), where=said + held > 0)).sum() / max(held.sum(), 1))


MEASURES = {"accuracy": _accuracy, "f1": _f1}


def search_trees(
    df: DataFrame, grid: Sequence[dict], fold: str, folds: int, label: str = "label", measure: str = "accuracy", seed: int = 0
) -> DataFrame:
    """``candidate, params, mean, spread, rank`` of all candidates of a classification tree; folds come from a column.

    Candidates that differ in depth or split size alone share one fit per fold, at the largest depth among
    them; held-out rows are counted by leaf and label, and every candidate is worked out from these counts. ``spread`` is
    twice the standard deviation over the folds; equal means share a rank. Deep trees on many rows are grown in tasks (``searched``).
    """
    fits: dict[tuple, int] = {}
    for c in grid:
        depth = DEEPEST if c["depth"] is None else c["depth"]
        key = c["impurity"], c["min_leaf"]
        fits[key] = max(fits.get(key, 0), depth)
    score = MEASURES[measure]

    with kept(df) as rows:
        held = rows.agg(F.max(label), F.count(F.lit(1))).first()
        classes, at_once = int(held[0]) + 1, SIDE_BY_SIDE if held[1] <= MANY_ROWS else FEWER

        if outgrows_models(rows, held[1], max(fits.values(), default=0)):
            tables = tables_of_search(rows, grid, fits, DEEPEST, fold, folds, label, classes, seed)
            return _ranked(df, grid, folds, {key: score(table) for key, table in tables.items()})

        def fit(job):
            """Scores of the candidates of one fit; its nodes are let go of."""
            (impurity, min_leaf), depth, k = job
            model = tree_classifier(impurity, depth, min_leaf, seed, labelCol=label, leafCol="leaf").fit(rows.where(F.col(fold) != k))
            found = model.transform(rows.where(F.col(fold) == k)).groupBy("leaf", label).agg(F.count(F.lit(1)).alias("n"))
            found = found.select(F.col("leaf").cast("int"), F.col(label).cast("int").alias("label"), "n").toArrow()  # leaves times labels
            tree = NodeColumns.of(model, df.sparkSession)
            del model
            levels, counts = tree.levels(), [found[c].to_numpy().astype(np.int64) for c in ("leaf", "label", "n")]
            own = [i for i, c in enumerate(grid) if (c["impurity"], c["min_leaf"]) == (impurity, min_leaf)]
            return {(i, k): score(_confusion(tree, levels, *counts, grid[i], classes)) for i in own}

        jobs = [(key, depth, k) for key, depth in fits.items() for k in range(folds)]
        with ThreadPool(at_once) as pool:
            done = pool.map(inheritable_thread_target(df.sparkSession)(fit), jobs, chunksize=1)

    return _ranked(df, grid, folds, {key: value for part in done for key, value in part.items()})


def _ranked(df: DataFrame, grid: Sequence[dict], folds: int, scored: Mapping[tuple[int, int], float]) -> DataFrame:
    results = []
    for i, c in enumerate(grid):
        values = [scored[i, k] for k in range(folds)]
        results.append((c, float(np.mean(values)), float(2 * np.std(values))))
    rows = [
        (i, ", ".join(f"{name}={value}" for name, value in sorted(c.items())), mean, spread, 1 + sum(other > mean for _, other, _ in results))
        for i, (c, mean, spread) in enumerate(results)
    ]
    return df.sparkSession.createDataFrame(rows, "candidate int, params string, mean double, spread double, rank int")
